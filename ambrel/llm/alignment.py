"""Alignment of two tokenizers' tokens over the same bytes.

A is a byte-level tokenizer's file, B a piece model; both encode space+text (B adds the space itself), so the tokens of
either tile the same bytes. The texts of a block, up to BLOCK_CHARS characters of an Arrow batch, are laid end to end:

* the ends of all A tokens are counted by byte offset once, and those of all B tokens; where both end, a group ends
* A and B tokens that overlap do so over a stretch without an end inside, and each stretch between ends is the overlap
  of one A and one B token: the links are the offsets where either ends, and running sums of the counts say whose
* what belongs to one document is a difference of running sums at its first and last byte; so is each token's place in
  the text of its document's groups

Links are counted by id pair within a block, where a pair gets a small number; a document keeps its pairs' numbers and
how often it has each. Blocks' pairs are summed over the corpus by a grouped sum, the highest count of each B id is found
among the sums, and both go back to the blocks by equality joins: of a pair's rows there is one a block, which holds
thousands of pairs, so no key is hot, and the work grows with the text. No pair of documents, nor any list of all pairs,
is ever made or sent to the driver.

Texts that are null, empty, or whose A or B bytes differ from space+text have no tokens: zeros and an empty digest.
Special strings are plain text. A text is read whole, a longer one than a block as a block of its own. Rows may repeat and
ids be null: each row is counted and has its result. An empty table gives no rows. Columns other than doc_id and text
are not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_pieces, new_path
from .packing import TRUSTED, ByteEncoder

BLOCK_CHARS = 1 << 22
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Pair:
    """Both tokenizers, their tokens' bytes and sizes, and the words that spell groups."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        from .token_counts import byte_letters

        self.a, letters = ByteEncoder(path_a), byte_letters()
        self.a.library.encode_special_tokens = True
        entries = self.a.library.get_vocab(True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([*map(len, x)], np.int64) for x in (self.bytes_a, self.bytes_b))
        n = len(self.bytes_a)
        self.words = np.array([f"{i}{end}" for i in range(n) for end in ",|"] + [f"{i}{end}" for i in range(len(self.bytes_b)) for end in ",;"], object)
        self.first_b = 2 * n

    def encode_a(self, text: str) -> np.ndarray:
        if not self.a.known or TRUSTED.search(text):
            return np.array(self.a.library.encode(text, add_special_tokens=False).ids, np.int32)
        return self.a.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    def tokens(self, texts: list[str]):
        """Ids by A and by B and the bytes of space+text; nothing for texts that their tokens do not spell."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            raw = f" {text}".encode()
            a, b = self.encode_a(f" {text}"), np.array(b, np.int32)
            spelt = text and all(b"".join(map(table.__getitem__, ids.tolist())) == raw for table, ids in ((self.bytes_a, a), (self.bytes_b, b)))
            out.append((a, b, len(raw)) if spelt else (a[:0], b[:0], 0))
        return out


@functools.lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _packed(x: np.ndarray) -> bytes:
    """The width in bytes, then the numbers."""
    top = int(x.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def align_block(tokens, machine: Pair):
    """Per document the COUNTS, digest of its groups and (pair numbers, times); the block's pairs as (a, b, n) arrays."""
    a, b = (np.concatenate([t[i] for t in tokens] or [np.zeros(0, np.int32)]) for i in (0, 1))
    n_a, n_b, sizes = (np.array([len(t[0]) for t in tokens], np.int64), np.array([len(t[1]) for t in tokens], np.int64), np.array([t[2] for t in tokens], np.int64))
    last = np.cumsum(sizes)
    first, total = last - sizes, int(sizes.sum())
    ends_a, ends_b = np.cumsum(machine.size_a[a]), np.cumsum(machine.size_b[b])
    at_a, at_b = (np.bincount(e, minlength=total + 1).astype(np.int8) for e in (ends_a, ends_b))
    done_a, done_b = (np.cumsum(x, dtype=np.int32) for x in (at_a, at_b))
    cut = at_a & at_b
    cuts = np.cumsum(cut, dtype=np.int32)
    links = np.flatnonzero(at_a | at_b)
    linked = np.searchsorted(links, [first, last], "right")
    counts = np.stack([n_a, n_b, cuts[last] - cuts[first], linked[1] - linked[0]])

    # groups spelt: A tokens of a group come after all B tokens of the groups before, B tokens after the A tokens of theirs
    places = np.flatnonzero(cut)
    of_a, of_b = cuts[ends_a] - cut[ends_a], cuts[ends_b] - cut[ends_b]
    spelling = np.empty(len(a) + len(b), np.int32)
    spelling[np.arange(len(a)) + np.append(0, done_b[places])[of_a]] = 2 * a + cut[ends_a]
    spelling[np.arange(len(b)) + np.append(0, done_a[places])[of_b + 1]] = machine.first_b + 2 * b + cut[ends_b]
    digests, at = [], 0
    for n in (n_a + n_b).tolist():
        digests.append(hashlib.sha256("".join(machine.words[spelling[at : at + n]].tolist())[:-1].encode()).hexdigest() if n else "")
        at += n

    # links by pair: numbered within the block, then counted within each document
    keys = a[done_a[links] - at_a[links]].astype(np.int64) << 32 | b[done_b[links] - at_b[links]]
    known, number, n = np.unique(keys, return_inverse=True, return_counts=True)
    places = np.sort(np.repeat(np.arange(len(tokens), dtype=np.int64), counts[3]) * max(len(known), 1) + number.reshape(-1))
    new = np.flatnonzero(np.append(True, places[1:] != places[:-1])) if len(places) else places
    times = np.diff(np.append(new, len(places)))
    doc, number = np.divmod(places[new], max(len(known), 1))
    split = np.searchsorted(doc, np.arange(1, len(tokens)))
    own = [*zip(np.split(number, split), np.split(times, split))] if len(tokens) else []
    return counts, digests, own, ((known >> 32).astype(np.int32), (known & 0xFFFFFFFF).astype(np.int32), n)


def token_links(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document (``at`` null) and one for each pair of each block (``at``: its number in the block), written once."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", *COUNTS, "groups_sha256", "numbers", "times", "block", "at", "a", "b", "n"]
    types = [None, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches):
        from pyspark import TaskContext

        machine, block = pair(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            schema = pa.schema([(n, t or ids.type) for n, t in zip(names, types)])
            for lo, hi in in_pieces(texts, block_chars):
                counts, digests, own, (a, b, n) = align_block(machine.tokens(texts[lo:hi]), machine)
                numbers = [_packed(np.diff(x, prepend=0)) for x, _ in own]
                none = lambda k: [pa.nulls(k, f.type) for f in schema]
                of_docs, of_pairs = none(hi - lo), none(len(a))
                of_docs[:9] = [ids.slice(lo, hi - lo), *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(numbers, pa.binary()), pa.array([_packed(x) for _, x in own], pa.binary()), pa.array([block] * (hi - lo), pa.int64())]
                of_pairs[8:] = [pa.array([block] * len(a), pa.int64()), pa.array(np.arange(len(a), dtype=np.int32)), pa.array(a), pa.array(b), pa.array(n, pa.int64())]
                block += 1
                yield pa.RecordBatch.from_arrays(of_docs, schema=schema)
                yield pa.RecordBatch.from_arrays(of_pairs, schema=schema)

    shape = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups_sha256 string, numbers binary, times binary, block long, at int, a int, b int, n long"
    made, path = docs.select("doc_id", "text").mapInArrow(run, shape), new_path(docs.sparkSession, "links")
    made.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def align_tokens(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, COUNTS, n_best, count_sum and groups_sha256 of every row of ``docs``."""
    rows = token_links(docs, path_a, path_b, block_chars)
    pairs = rows.where("at is not null").select("block", "at", "a", "b", "n")
    sums = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    tops = sums.groupBy("b").agg(F.max("count").alias("top"))  # at most as many rows as B has ids
    rated = sums.join(tops, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))
    told = pairs.join(rated.hint("merge"), ["a", "b"]).select(F.col("block").alias("home"), "at", "count", "best")
    out = f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in (*COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"

    def finish(left, right):
        counts, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right["at"].to_numpy()
        counts[at], best[at] = right["count"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        n_best, total = [], []
        for numbers, times in zip(left["numbers"].to_pylist(), left["times"].to_pylist()):
            which, times = np.cumsum(_unpacked(numbers), dtype=np.int64), _unpacked(times).astype(np.int64)
            n_best.append(int(times @ best[which]))
            total.append(int(times @ counts[which]))
        kept = {"doc_id": left["doc_id"], **{c: left[c] for c in COUNTS}, "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64()), "groups_sha256": left["groups_sha256"]}
        return pa.table(kept)

    of_docs = rows.where("at is null").select("block", "doc_id", *COUNTS, "groups_sha256", "numbers", "times")
    return of_docs.groupBy("block").cogroup(told.groupBy("home")).applyInArrow(finish, out)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
