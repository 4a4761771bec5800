"""Ranked lexical search with variable-block-max WAND.

Three tables, each written once in the shared folder:

* postings: tasks deal their documents into shards of at most SHARD_DOCS documents or about SHARD_POSTINGS postings, a longer
  document a shard of its own, and invert them where they are, without a shuffle. Within a shard documents are numbered
  by doc_id, so equal scores go by number. Only terms that a query holds get postings while those are at most TERM_BYTES;
  beyond that all terms do. Lengths count every term of every document.
* index: with the corpus's totals known, every posting gets its impact, the score without the term's weight, and every list
  its blocks: a dynamic program over the list chooses the boundaries that make what the blocks' greatest impacts
  overstate over the documents they cover, plus BLOCK_COST a block, least among all cuts into blocks of at most MOST
  postings. Lists are cut a batch at a time, position by position.
* found: each shard's best K documents for each query.

A shard is searched for a block of at most BLOCK_QUERIES queries at a time, with the lists of their terms alone. A
document's bound is the sum of the greatest impacts, times weights, of the blocks that cover it. Documents are taken by
descending bound, a few and then ever more; of each list only blocks that cover one of them are opened, and the K-th score
so far ends the search once no bound reaches it. Bounds that equal it are still opened, so results are exact, ties too.
Shards' lists are merged by rank. Nothing of the corpus but its totals, two numbers, and no more terms than TERM_BYTES of
the queries' go through the driver.

Null and empty texts and those without a term have no terms: such documents are not counted, such items give no rows.
Texts are read whole. Rows may repeat and ids be null: each row is a document, or an item, of its own; a null doc_id comes
last among equal scores. Empty tables give no rows. Columns other than doc_id, item_id and text are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import as_table, new_path

K, SHARD_DOCS, SHARD_POSTINGS, BLOCK_QUERIES, TERM_BYTES = 10, 1 << 14, 1 << 21, 1024, 1 << 24
MOST, BLOCK_COST, FIRST, MORE = 64, 2_000_000, 512, 8
#: Bytes that stand in terms, with A-Z in lower case; all others part terms.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_LETTERS).split()


def query_terms(items: DataFrame) -> DataFrame:
    """query (a number), item_id and term: the terms of every row of ``items``, once each."""
    kind = dict(items.dtypes)["item_id"]

    def run(batches):
        for batch in batches:
            which, found = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = set(terms(text or ""))
                which += [i] * len(own)
                found += [t.decode() for t in own]
            rows = pa.array(which, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("query").take(rows), batch.column("item_id").take(rows), pa.array(found, pa.string())], ["query", "item_id", "term"])

    numbered = items.select(F.monotonically_increasing_id().alias("query"), "item_id", "text")
    return as_table(numbered.mapInArrow(run, f"query long, item_id {kind}, term string"), "query-terms")


def postings(docs: DataFrame, wanted: set[bytes] | None = None, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Rows of lists (shard, term, docs, tfs, sizes) and, without term, a row for each shard (ids, terms in all)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        ids, sizes, numbers, tfs, held = [], [], [], [], 0
        vocabulary, schema = {}, None

        def close():
            nonlocal ids, sizes, numbers, tfs, held, vocabulary, shard
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            place = np.empty(len(ids), np.uint32)
            place[order] = np.arange(len(ids), dtype=np.uint32)
            size = np.array(sizes, np.uint32)
            doc = np.repeat(np.arange(len(ids)), [len(x) for x in numbers])
            number, tf = np.concatenate(numbers), np.concatenate(tfs)
            by = np.lexsort((place[doc], number))
            doc, number, tf = doc[by], number[by], tf[by]
            cuts = np.flatnonzero(np.diff(number, prepend=-1))
            names = [t.decode() for t in vocabulary]
            cut = lambda x: [part.tobytes() for part in np.split(x, cuts[1:])] if len(cuts) else []
            lists = {"term": [names[i] for i in number[cuts].tolist()], "docs": cut(place[doc]), "tfs": cut(tf), "sizes": cut(size[doc])}
            whole = {"shard": [shard], "ids": [[ids[i] for i in order]], "total": [int(size.sum())]}
            for columns, n in ((whole, 1), (lists | {"shard": [shard] * len(cuts)}, len(cuts))):
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)
            ids, sizes, numbers, tfs, held, vocabulary, shard = [], [], [], [], 0, {}, shard + 1

        for batch in batches:
            schema = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("docs", pa.binary()), ("tfs", pa.binary()), ("sizes", pa.binary()), ("ids", pa.list_(batch.column("doc_id").type)), ("total", pa.int64())])
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = terms(text or "")
                if not words:
                    continue
                counts = Counter(words)
                own = counts if wanted is None else wanted & counts.keys()
                ids.append(key)
                sizes.append(len(words))
                numbers.append(np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in own), np.int64, len(own)))
                tfs.append(np.fromiter((counts[t] for t in own), np.uint32, len(own)))
                held += len(own)
                if len(ids) == shard_docs or held >= SHARD_POSTINGS:
                    yield from close()
        if ids:
            yield from close()

    shape = f"shard long, term string, docs binary, tfs binary, sizes binary, ids array<{kind}>, total long"
    made, path = docs.select("doc_id", "text").mapInArrow(run, shape), new_path(docs.sparkSession, "postings")
    made.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def block_ends(docs: np.ndarray, impacts: np.ndarray, sizes: np.ndarray, most: int = MOST, cost: int = BLOCK_COST) -> np.ndarray:
    """Whether a block ends at each posting of lists of ``sizes`` that lie one after the other.

    A block bounds every document from its first to its last by its greatest impact. Of all cuts of a list into blocks of at
    most ``most`` postings these have the least sum of documents covered times greatest impact (what the bounds overstate,
    but for the list's own sum), plus ``cost`` a block. Column j belongs to the latest start s with s % most == j: its
    document, the greatest impact since s, and the least cost of what lies before s.
    """
    order = np.argsort(-sizes, kind="stable")
    sizes, starts = sizes[order], (np.cumsum(sizes) - sizes)[order]
    first, high = np.zeros((2, len(sizes), most), np.int64)
    paid = np.full((len(sizes), most), np.iinfo(np.int64).max // 2)
    least, back, columns = np.zeros(len(sizes), np.int64), np.empty(len(impacts), np.int32), np.arange(most)
    active = np.searchsorted(-sizes, -np.arange(1, sizes.max(initial=0) + 1), "right")  # lists with a posting at each position
    for i, n in enumerate(active.tolist()):
        at = starts[:n] + i
        doc, impact = docs[at].astype(np.int64), impacts[at].astype(np.int64)
        first[:n, i % most], high[:n, i % most], paid[:n, i % most] = doc, 0, least[:n]
        np.maximum(high[:n], impact[:, None], out=high[:n])
        total = high[:n] * (doc[:, None] + 1 - first[:n]) + paid[:n]
        best = total.argmin(1)
        least[:n] = total[np.arange(n), best] + cost
        back[at] = (i - columns[best]) % most + 1
    ends, at = np.zeros(len(impacts), bool), sizes.copy()
    while (going := at > 0).any():
        last = starts[going] + at[going] - 1
        ends[last] = True
        at[going] -= back[last]
    return ends


def impacts_of(tf: np.ndarray, size: np.ndarray, n: int, total: int) -> np.ndarray:
    m = 10 + (90 * size.astype(np.int64) * n) // total
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def index(lists: DataFrame, n: int, total: int) -> DataFrame:
    """Lists of postings with impacts and block ends (places in the list, exclusive)."""

    def run(batches):
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("docs", "tfs", "sizes")}
            lengths = np.array([len(x) // 4 for x in columns["docs"]], np.int64)
            tf, size = (np.frombuffer(b"".join(columns[c]), "<u4") for c in ("tfs", "sizes"))
            impacts = impacts_of(tf, size, n, total).astype("<u4")
            ends = block_ends(np.frombuffer(b"".join(columns["docs"]), "<u4"), impacts, lengths)
            firsts = np.cumsum(lengths) - lengths
            own = [(np.flatnonzero(ends[a : a + k]) + 1).astype("<u4").tobytes() for a, k in zip(firsts.tolist(), lengths.tolist())]
            parts = [impacts[a : a + k].tobytes() for a, k in zip(firsts.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("term"), batch.column("docs"), pa.array(parts, pa.binary()), pa.array(own, pa.binary())], ["shard", "term", "docs", "impacts", "ends"])

    made, path = lists.select("shard", "term", "docs", "tfs", "sizes").mapInArrow(run, "shard long, term string, docs binary, impacts binary, ends binary"), new_path(lists.sparkSession, "index")
    made.write.option("compression", "zstd").parquet(path)
    return lists.sparkSession.read.schema(made.schema).parquet(path)


class Shard:
    """Lists of some terms over ``n`` documents, ready for block-skipping search."""

    def __init__(self, n: int, lists):
        """``lists``: (docs, impacts, ends, weight) of each term."""
        self.n, self.of_term, at, blocks = n, [], 0, 0
        docs, scores, starts, stops = [], [], [], []
        for d, impacts, ends, weight in lists:
            docs.append(d.astype(np.int64))
            scores.append(impacts.astype(np.int64) * weight)
            stops.append(ends.astype(np.int64) + at)
            starts.append(np.append(0, ends[:-1]).astype(np.int64) + at)
            self.of_term.append((blocks, blocks + len(ends)))
            at, blocks = at + len(d), blocks + len(ends)
        self.docs, self.scores, self.starts, self.stops = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (docs, scores, starts, stops))
        self.first, self.last = self.docs[self.starts], self.docs[self.stops - 1]
        self.top = np.maximum.reduceat(self.scores, self.starts) if blocks else self.scores
        self.opened = np.zeros(blocks, bool)

    def _sums(self, at: np.ndarray, values: np.ndarray, most: int) -> np.ndarray:
        if most < 1 << 53:  # exact as floating point
            return np.bincount(at, values, self.n + 1).astype(np.int64)
        out = np.zeros(self.n + 1, np.int64)
        np.add.at(out, at, values)
        return out

    def search(self, own: list[int], k: int):
        """Numbers and scores of the best ``k`` documents for the terms ``own``, best first."""
        blocks = np.concatenate([np.arange(*self.of_term[t]) for t in own])
        first, last, top = self.first[blocks], self.last[blocks], self.top[blocks]
        most = int(top.sum())
        bound = np.cumsum(self._sums(first, top, most) - self._sums(last + 1, top, most))[: self.n]
        order, done, size = np.argsort(-bound, kind="stable"), 0, FIRST
        best, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        while done < self.n and bound[order[done]] >= least:
            some = order[done : done + size]
            some = some[bound[some] >= least]
            chosen = np.zeros(self.n + 1, bool)
            chosen[some] = True
            before = np.append(0, np.cumsum(chosen))
            open_blocks = blocks[before[last + 1] > before[first]]
            self.opened[open_blocks] = True
            lengths = self.stops[open_blocks] - self.starts[open_blocks]
            which = np.arange(lengths.sum()) + np.repeat(self.starts[open_blocks] - np.cumsum(lengths) + lengths, lengths)
            docs = self.docs[which]
            kept = chosen[docs]
            sums = self._sums(docs[kept], self.scores[which[kept]], most)
            best, scores = np.append(best, some), np.append(scores, sums[some])
            by = np.lexsort((best, -scores))[:k]
            by = by[scores[by] > 0]
            best, scores = best[by], scores[by]
            if len(by) == k:
                least = max(1, int(scores[-1]))
            done, size = done + size, size * MORE
        return best, scores


def search(lists: DataFrame, shards: DataFrame, asked: DataFrame, n_blocks: int, k: int = K) -> DataFrame:
    """query, doc_id and score of each shard's best; ``asked``: block, term, weight and the queries that hold the term."""
    kind = dict(shards.dtypes)["ids"][len("array<") : -1]
    left = lists.join(asked, "term").select("shard", "block", "docs", "impacts", "ends", "weight", "queries")
    right = shards.select(F.col("shard").alias("of"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("for"), "ids")

    def run(left, right):
        ids = right["ids"].combine_chunks().flatten() if right.num_rows else pa.array([], pa.int64())
        queries, places, scores = [], [], []
        if left.num_rows and right.num_rows:
            numbers = lambda c: [np.frombuffer(x, "<u4") for x in left[c].to_pylist()]
            shard, own = Shard(len(ids), zip(numbers("docs"), numbers("impacts"), numbers("ends"), left["weight"].to_pylist())), {}
            for i, some in enumerate(left["queries"].to_pylist()):
                for q in some:
                    own.setdefault(q, []).append(i)
            for q, of in own.items():
                best, score = shard.search(of, k)
                queries += [q] * len(best)
                places += best.tolist()
                scores += score.tolist()
        return pa.table({"query": pa.array(queries, pa.int64()), "doc_id": ids.take(pa.array(places, pa.int64())), "score": pa.array(scores, pa.int64())})

    return left.groupBy("shard", "block").cogroup(right.groupBy("of", "for")).applyInArrow(run, f"query long, doc_id {kind}, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = K, block_queries: int = BLOCK_QUERIES, shard_docs: int = SHARD_DOCS, term_bytes: int = TERM_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score: the ``k`` best documents of each row of ``items`` with a score above 0."""
    spark, kinds = docs.sparkSession, (dict(items.dtypes)["item_id"], dict(docs.dtypes)["doc_id"])
    empty = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    held = query_terms(items)
    distinct = held.select("term").distinct()
    size = distinct.agg(F.sum(F.octet_length("term")).alias("bytes")).join(held.agg(F.countDistinct("query").alias("queries"))).first()
    if not size["queries"]:
        return empty
    wanted = {r["term"].encode() for r in distinct.collect()} if size["bytes"] <= term_bytes else None
    made = postings(docs, wanted, shard_docs)
    shards, lists = made.where("term is null").select("shard", "ids", "total"), made.where("term is not null")
    whole = shards.agg(F.sum(F.size("ids")).alias("n"), F.sum("total").alias("total")).first()
    if not whole["n"]:
        return empty
    lists = index(lists, whole["n"], whole["total"])
    n_blocks = -(-size["queries"] // block_queries)
    weight = F.floor(1000 * F.log((2 * F.lit(whole["n"]) + 2).cast("double") / (2 * F.sum(F.octet_length("docs").cast("long")) / 4 + 1))).cast("long")
    block = F.pmod(F.xxhash64("query"), F.lit(n_blocks)).cast("long")
    asked = held.groupBy(block.alias("block"), "term").agg(F.collect_list("query").alias("queries"))  # a block's queries at most
    asked = asked.join(lists.groupBy("term").agg(weight.alias("weight")), "term")
    found = search(lists, shards.drop("total"), asked, n_blocks, k)
    by = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return best.join(held.select("query", "item_id").distinct(), "query").select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return rank(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
t AS (SELECT row, doc_id, unnest(terms) AS term FROM d), tf AS (SELECT row, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
size AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row), whole AS (SELECT count(*) AS n, sum(n)::BIGINT AS total FROM size),
w AS (SELECT term, floor(1000 * ln((2 * any_value(whole.n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, whole GROUP BY term),
q AS (SELECT row_number() OVER () AS query, item_id, list_distinct({_TERMS}) AS terms FROM benchmark), asked AS (SELECT query, item_id, unnest(terms) AS term FROM q),
s AS (SELECT query, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size.n * whole.n) // whole.total))))::BIGINT AS score
      FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN size USING (row), whole GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= {K}"""
