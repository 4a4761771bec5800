"""Content-addressed store of token ids.

A document's ids (with an end id) are cut where a rolling hash of the last
WINDOW ids has its low bits zero, between MIN_CHUNK and MAX_CHUNK ids, so equal
passages give equal chunks wherever they stand. The store is four tables:

* chunks: hash (blake2b-128), n, data (little-endian ids, 16 bits wide if the vocabulary allows); each once
* recipes: row (ascending with doc_id), part, doc_id, n_tokens, hashes and the document's root, range-partitioned and sorted by doc_id
* tree: the Merkle tree over the documents' roots, FAN children a node: level by level within each part of
  the recipes, then over the parts; a node has its documents, ids and hash
* manifest: one row with the tree's root, documents, ids, the bytes of an id, the end id and the format's name

Everything that reading needs stands in these files. Reading checks the manifest's
format, each chunk against its hash, each document's root against the hashes found,
and the tree built anew from those roots, node by node and up to the manifest's
root; a mismatch raises, whichever of the four tables was damaged. CRC-32 sums of
documents come from those of their chunks by the CRC's shift operator, so no ids
are shuffled to sum a document up; read_ids() rebuilds the ids themselves.

Null and empty texts hold the end id only; texts of any length are encoded whole.
Rows may repeat and ids be null (first in order): rows of equal id stand one after
the other in any order. An empty table makes a store without rows. Only doc_id and
text are read, whatever other columns are called.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import in_pieces, new_path

END_ID, WINDOW, MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 2, 8, 64, 8, 1024
FAN_BITS, FORMAT = 8, "token-store/2"
PLACE = (1 << 33) - 1  # the bits of a row number that count within its part
#: Code points whose lower case Python and the library agree on.
TRUSTED = re.compile("[^\t-\r -~\xa0-ʯΑ-ΡΣ-ώЀ-џ‐-‧€]")
#: What the tokenizer takes for words of their own beside runs of letters (of TRUSTED code points).
NOT_LETTERS = re.compile(r"'(?:[stmd]|re|ve|ll)|[0-9²³¹¼½¾]|(?:[^\s\w]|_)+")
#: The same without the apostrophe's cases, in classes that the regex engine scans for fast.
DIGIT = re.compile("[0-9²³¹¼½¾]")
MARKS = re.compile("[%s]+" % re.escape("".join(sorted({c for t in map(chr, range(0x20AD)) if not TRUSTED.match(t) for c in t.lower() if re.match(r"[^\s\w]|_", c)}))))


class _Words(dict):
    """Numbers of words in the order met; ``new`` are those that nobody has encoded yet."""

    def __init__(self):
        super().__init__()
        self.new, self.chars = [], 0

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        self.chars += len(word)
        return at


class WordEncoder:
    """Ids of whole texts of a vocabulary with word ends, numbered in merge order.

    Each word is encoded when first met and then looked up; what is known is forgotten beyond KNOWN words or characters,
    between texts, so it changes no id. New words are encoded together: the file's merges, read as ranks, drive the faster
    tiktoken core, where a space after each word stands for its end: letters with a word end have lower ids than all
    merges, so a word's end joins its last letter first, as it stands from the beginning in the library. Texts with special
    strings or code points outside TRUSTED go to the library whole.
    """

    END = "</w>"
    KNOWN, KNOWN_CHARS, PIECE = 1 << 19, 1 << 23, 1 << 22

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        from .token_counts import byte_letters

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.special = [t.lower() for t in special]  # a text may hold them in any case: lower-casing comes after
        letters = byte_letters()
        ranks, self.last = {}, np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab(False).items():
            if token not in special:
                body = token.removesuffix(self.END)
                ranks[bytes(letters[c] for c in body) + b" " * (body != token)] = i
                self.last[i] = body != token
        self.fast = tiktoken.Encoding("ranks", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self.words, self.flat, self.ends = _Words(), np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def _learn(self) -> None:
        if self.words.new:
            ids = self.fast.encode_to_numpy(" ".join(self.words.new) + " ", disallowed_special=())
            self.ends = np.append(self.ends, np.flatnonzero(self.last[ids]) + 1 + len(self.flat))
            self.flat = np.append(self.flat, ids.astype(self.dtype))
            self.words.new = []

    def _words_of(self, text: str) -> list[str] | None:
        """The words of a text; none at all if the library has to encode it."""
        lower = text.replace("Σ", "σ").lower()
        if TRUSTED.search(text) or any(s in lower for s in self.special):
            return None
        apart = NOT_LETTERS.sub(r" \g<0> ", lower) if "'" in lower else DIGIT.sub(r" \g<0> ", MARKS.sub(r" \g<0> ", lower))
        return apart.split()

    def _ids_of_all(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > self.KNOWN or self.words.chars > self.KNOWN_CHARS:
            self._forget()
        number, places = self.words.__getitem__, []
        for text in texts:
            words = self._words_of(text)
            places.append(None if words is None else np.fromiter(map(number, words), np.int32, len(words)))
        self._learn()
        out = []
        for text, at in zip(texts, places):
            if at is None:
                out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype))
                continue
            start = self.ends[at]
            n = self.ends[at + 1] - start
            before = np.cumsum(n) - n
            out.append(self.flat[np.repeat(start - before, n) + np.arange(n.sum())])
        return out

    def ids_of(self, text: str) -> np.ndarray:
        return self._ids_of_all([text])[0]

    def encode(self, texts: list[str], end_id: int):
        """The ids of each text, as arrays; copies near each other in a batch are encoded once."""
        end = np.array([end_id], self.dtype)
        for a, b in in_pieces(texts, self.PIECE):
            some = list(dict.fromkeys(texts[a:b]))
            met = dict(zip(some, self._ids_of_all(some)))
            for text in texts[a:b]:
                yield np.append(met[text], end)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@functools.lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    """A random number for the low 16 bits of an id."""
    return np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 32, 1 << 16, dtype="u4")


def chunk_ends(ids: np.ndarray) -> list[int]:
    """Where the chunks of a document end."""
    n = len(ids)
    if n <= MIN_CHUNK:
        return [n] if n else []
    g = _gear()[ids & 0xFFFF]
    h = g.copy()
    for k in range(1, WINDOW):
        h[k:] += g[:-k] << np.uint32(k)
    cuts = np.flatnonzero(h & np.uint32(((1 << MEAN_BITS) - 1) << 16) == 0) + 1
    ends, start = [], 0
    for c in [*cuts.tolist(), n]:
        while c - start > MAX_CHUNK:
            start += MAX_CHUNK
            ends.append(start)
        if c - start >= MIN_CHUNK or c == n and c > start:
            ends.append(c)
            start = c
    return ends


def address(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _staged(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    def run(batches):
        machine = encoder(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for ids in machine.encode(texts, end_id):
                ends = chunk_ends(ids)
                data = [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]
                hashes = [address(d) for d in data]
                rows.append((len(ids), hashes, data, address(b"".join(hashes))))
            n, hashes, data, roots = zip(*rows) if rows else ((), (), (), ())
            types = (pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.binary())
            cols = [pa.array(list(c), t) for c, t in zip((n, hashes, data, roots), types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], ["doc_id", "n_tokens", "hashes", "data", "root"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, hashes array<binary>, data array<binary>, root binary")


def write_store(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> dict:
    """Write the store's tables under ``path``; returns the manifest's row."""
    spark = docs.sparkSession
    staged_at = f"{path}/staged"
    _staged(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(staged_at)
    staged = spark.read.parquet(staged_at)
    width = encoder(tokenizer).dtype.itemsize
    each = staged.select(F.explode(F.arrays_zip("hashes", "data")).alias("c")).select(F.col("c.hashes").alias("hash"), F.col("c.data").alias("data"))
    unique = each.groupBy("hash").agg(F.first("data").alias("data"))
    unique.select("hash", (F.length("data") / width).cast("int").alias("n"), "data").write.option("compression", "zstd").parquet(f"{path}/chunks")
    recipes = staged.select("doc_id", "n_tokens", "hashes", "root").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    recipes = recipes.select(F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("part"), "*")
    recipes.write.parquet(f"{path}/recipes")
    spark._jvm.org.apache.hadoop.fs.Path(staged_at).getFileSystem(spark._jsc.hadoopConfiguration()).delete(spark._jvm.org.apache.hadoop.fs.Path(staged_at), True)
    top = _write_tree(spark.read.parquet(f"{path}/recipes"), f"{path}/tree")
    manifest = {"format": FORMAT, "root": top["root"], "documents": top["documents"], "ids": top["ids"], "width": width, "end_id": end_id}
    spark.createDataFrame([tuple(manifest.values())], "format string, root binary, documents long, ids long, width int, end_id int").coalesce(1).write.parquet(f"{path}/manifest")
    return manifest


def _inner_levels(roots: DataFrame) -> int:
    """Levels of the tree within the parts, 1 at least."""
    most = roots.agg(F.max(F.col("row").bitwiseAND(PLACE)).alias("m")).first()["m"] or 0
    return max(1, -(-most.bit_length() // FAN_BITS))


def _write_tree(roots: DataFrame, path: str) -> dict:
    """Write the Merkle tree over ``roots`` (row, part, n_tokens, root), a folder a level; returns the top node."""
    spark, inner, level = roots.sparkSession, _inner_levels(roots), 0
    nodes = roots.select("part", F.col("row").bitwiseAND(PLACE).alias("node"), F.lit(1).cast("long").alias("documents"), F.col("n_tokens").alias("ids"), "root")
    while True:
        own = "node" if level < inner else "part"
        parent = {own: F.shiftright(own, FAN_BITS)} | ({"node": F.lit(0).cast("long")} if own == "part" else {})
        nodes = nodes.withColumn("own", F.col(own)).withColumns(parent)
        children = F.sort_array(F.collect_list(F.struct("own", "root")))  # 1 << FAN_BITS at most
        grouped = nodes.groupBy("part", "node").agg(F.sum("documents").alias("documents"), F.sum("ids").alias("ids"), children.alias("c"))
        joined = F.array_join(F.transform("c", lambda x: F.hex(x["root"])), "")
        grouped.select("part", "node", "documents", "ids", F.unhex(F.sha2(joined.cast("binary"), 256)).alias("root")).write.parquet(f"{path}/level={level}")
        nodes = spark.read.parquet(f"{path}/level={level}")
        level += 1
        if level >= inner:
            parts = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("part").alias("m")).first()
            if not parts["n"]:
                return {"root": b"", "documents": 0, "ids": 0}
            if parts["n"] == 1 and parts["m"] == 0:
                return nodes.first().asDict()


def manifest(spark, path: str) -> dict:
    rows = spark.read.parquet(f"{path}/manifest").collect()
    if len(rows) != 1 or rows[0]["format"] != FORMAT:
        raise ValueError(f"no manifest of a {FORMAT} store")
    return rows[0].asDict()


def _checked_chunks(spark, path: str, width: int, with_data: bool) -> DataFrame:
    """hash, n and crc of the stored chunks (and data), each checked against its address."""

    def run(batches):
        for batch in batches:
            hashes, data = batch.column("hash").to_pylist(), batch.column("data").to_pylist()
            crc = []
            for h, d, n in zip(hashes, data, batch.column("n").to_pylist()):
                if address(d) != h or len(d) != n * width:
                    raise ValueError(f"chunk {h.hex()} is damaged")
                crc.append(zlib.crc32(np.frombuffer(d, f"<u{width}").astype("<u4").tobytes()))
            out = [batch.column("hash"), batch.column("n"), pa.array(crc, pa.int64())] + [batch.column("data")] * with_data
            yield pa.RecordBatch.from_arrays(out, ["hash", "n", "crc"] + ["data"] * with_data)

    return spark.read.parquet(f"{path}/chunks").mapInArrow(run, "hash binary, n int, crc long" + ", data binary" * with_data)


@functools.lru_cache(maxsize=4096)
def _shift(n_bytes: int) -> tuple[tuple[int, ...], ...]:
    """Tables of the linear map that appending n_bytes zero bytes makes of a CRC-32 register."""
    columns = [zlib_shift(1 << i, n_bytes) for i in range(32)]
    tables = []
    for byte in range(4):
        table = [0] * 256
        for v in range(1, 256):
            low = v & -v
            table[v] = table[v ^ low] ^ columns[8 * byte + low.bit_length() - 1]
        tables.append(tuple(table))
    return tuple(tables)


def zlib_shift(register: int, n_bytes: int) -> int:
    """The register after n_bytes zero bytes, without the initial and final complements."""
    return zlib.crc32(bytes(n_bytes), register ^ 0xFFFFFFFF) ^ 0xFFFFFFFF


def crc_join(parts) -> int:
    """The CRC-32 of joined data, from (crc, bytes) of its parts."""
    crc = 0
    for c, n in parts:
        t = _shift(n)
        crc = t[0][crc & 255] ^ t[1][crc >> 8 & 255] ^ t[2][crc >> 16 & 255] ^ t[3][crc >> 24] ^ c
    return crc


def _joined(spark, path: str, width: int, with_data: bool) -> DataFrame:
    recipes = spark.read.parquet(f"{path}/recipes")
    steps = recipes.select("row", "part", "doc_id", "root", F.posexplode("hashes").alias("pos", "hash"))
    chunks = _checked_chunks(spark, path, width, with_data)
    item = F.struct("pos", "hash", "n", "crc", *["data"] * with_data)
    return steps.join(chunks, "hash", "left").groupBy("row", "part", "doc_id", "root").agg(F.sort_array(F.collect_list(item)).alias("items"))


def read_digests(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of 32-bit ids) of every document, from the store's files, checked."""
    said = manifest(spark, path)

    def run(batches):
        for batch in batches:
            items = batch.column("items")
            hashes, sizes, sums = (items.flatten().field(k).to_pylist() for k in ("hash", "n", "crc"))
            ends = items.offsets.to_numpy() - items.offsets[0].as_py()
            n, crc = [], []
            for a, b, root in zip(ends[:-1].tolist(), ends[1:].tolist(), batch.column("root").to_pylist()):
                if None in sizes[a:b] or address(b"".join(hashes[a:b])) != root:
                    raise ValueError("a document's chunks do not give its root")
                n.append(sum(sizes[a:b]))
                crc.append(crc_join(zip(sums[a:b], [4 * k for k in sizes[a:b]])))
            out = [batch.column("row"), batch.column("part"), batch.column("doc_id"), batch.column("root"), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, ["row", "part", "doc_id", "root", "n_tokens", "ids_crc32"])

    joined = _joined(spark, path, said["width"], False)
    kind = dict(joined.dtypes)["doc_id"]
    found_at = new_path(spark, "digests")
    joined.mapInArrow(run, f"row long, part int, doc_id {kind}, root binary, n_tokens long, ids_crc32 long").write.parquet(found_at)
    found = spark.read.parquet(found_at)
    again = new_path(spark, "tree")
    top = _write_tree(found, again)
    tree, anew = (spark.read.parquet(p) for p in (f"{path}/tree", again))
    same = " and ".join(f"a.{c} <=> b.{c}" for c in ("level", "part", "node", "documents", "ids", "root"))
    if tree.alias("a").join(anew.alias("b"), F.expr(same), "left_anti").union(anew.alias("a").join(tree.alias("b"), F.expr(same), "left_anti")).count():
        raise ValueError("the documents do not give the nodes of the tree")
    if any(top[c] != said[c] for c in ("root", "documents", "ids")):
        raise ValueError("the tree does not give the root in the manifest")
    parts = tree.where(F.col("level") == _inner_levels(found) - 1).select("part", "ids")
    before = parts.select("part", (F.sum("ids").over(W.orderBy("part")) - F.col("ids")).alias("before"))  # a row for each file of recipes
    run_up = F.sum("n_tokens").over(W.partitionBy("part").orderBy("row")) - F.col("n_tokens")
    return found.withColumn("inside", run_up).join(before, "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark, path: str) -> DataFrame:
    """row, doc_id and ids (array<int>) of every document, each chunk and document's root checked."""
    width = manifest(spark, path)["width"]

    def run(batches):
        for batch in batches:
            items = batch.column("items").to_pylist()
            for row, root in zip(items, batch.column("root").to_pylist()):
                if any(i["n"] is None for i in row) or address(b"".join(i["hash"] for i in row)) != root:
                    raise ValueError("a document's chunks do not give its root")
            ids = [np.frombuffer(b"".join(i["data"] for i in row), f"<u{width}").astype("i4") for row in items]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["row", "doc_id", "ids"])

    joined = _joined(spark, path, width, True)
    return joined.mapInArrow(run, f"row long, doc_id {dict(joined.dtypes)['doc_id']}, ids array<int>")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = new_path(spark, "token-store")
    write_store(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    return read_digests(spark, path)
