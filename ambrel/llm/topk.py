"""Exact top-k inner products by KD-trees, one a shard.

Vectors are dealt into shards by a hash; each shard is packed as a few columns of
bytes with its KD-tree: median splits along the widest component, and for every
node the tight bounding box of its vectors. Queries are packed in blocks, which
travel to the shards, being the smaller part; an equality join on (shard, block)
gives each task one shard and one block at a time, so memory is bounded whatever
the input, and no task sees the whole table.

A first pass lets every block meet one shard. The k-th score that a query finds
there is a lower bound of its k-th score overall, and goes with the block to all
other shards ("propagated"): a node is opened only if the largest inner product
its box allows could still enter the list, best bound first, and a shard sends
back at most k candidates for a query, none below its bound. The lists of all
shards are merged by rank, partial ranks first.

Shard and block sizes are fixed; blocks over shards is the stated "query set
against all rows, in blocks": the work grows with the product of queries and rows.

Scores are exact 64-bit integers. Vectors that are null, empty or hold null or
non-finite components take no part, nor do those of another length than their
query or rows without id; an empty table gives no rows. Vectors have any length
and magnitude: shards with components of 2**24 or more after scaling are held in
64 bits, and where sums may pass 64 bits Python's integers count. As in the SQL, a
scaled component or a score in the result that does not fit 64 bits is an error.
Rows have numbers of their own: of rows with one id each is a query and a candidate
of the others, and a query leaves out itself alone. Ties go to the smaller id.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import as_table

K, EVERY, SCALE = 5, 50, 256
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 8192, 2048, 64
PACK = "group long, dim int, rows binary, ids binary, vectors binary, boxes binary, nodes binary"


def build_tree(x: np.ndarray):
    """The order of the rows in the tree, boxes (nodes, 2, dim) and nodes (from, to, left, right; -1 for leaves)."""
    order, nodes, boxes = np.arange(len(x)), [], []

    def grow(lo: int, hi: int) -> int:
        part = x[order[lo:hi]]
        low, high = part.min(0), part.max(0)
        at = len(nodes)
        nodes.append([lo, hi, -1, -1])
        boxes.append((low, high))
        if hi - lo > LEAF_ROWS and (high > low).any():
            axis = int(np.argmax(high - low))
            mid = (lo + hi) // 2
            order[lo:hi] = order[lo:hi][np.argpartition(part[:, axis], mid - lo)]
            nodes[at][2], nodes[at][3] = grow(lo, mid), grow(mid, hi)
        return at

    grow(0, len(x))
    return order, np.array(boxes, x.dtype), np.array(nodes, "i4")


def _packer(with_tree: bool):
    def pack(key, table):
        rows, ids = table["row"].to_numpy(), table["vec_id"].to_numpy()
        order = np.argsort(rows, kind="stable")
        dim = table["dim"][0].as_py()
        x = np.asarray(table["x"].combine_chunks().flatten()).reshape(len(ids), dim)
        low, high = int(x.min(initial=0)), int(x.max(initial=0))
        if low == -(1 << 63) or high == (1 << 63) - 1:  # where floor() ends
            raise ValueError("scaled components must fit 64 bits")
        x = x.astype("i4" if max(-low, high) < 1 << 24 else "i8")
        boxes = nodes = np.empty(0, "i4")
        if with_tree:
            inner, boxes, nodes = build_tree(x[order])
            order = order[inner]
        made = {"group": [key[0].as_py()], "dim": [dim], "rows": [rows[order].astype("i8").tobytes()], "ids": [ids[order].astype("i8").tobytes()], "vectors": [x[order].tobytes()], "boxes": [boxes.tobytes()], "nodes": [nodes.tobytes()]}
        return pa.table(made, schema=pa.schema([("group", pa.int64()), ("dim", pa.int32()), *[(n, pa.binary()) for n in ("rows", "ids", "vectors", "boxes", "nodes")]]))

    return pack


def _search(q: np.ndarray, q_rows: np.ndarray, least: list, rows, ids, x, boxes, nodes, k: int) -> list[list[tuple[int, int]]]:
    """For each query a heap of at most k (score, -id) of the shard, none below its ``least`` (None: no bound)."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * x.shape[1]
    if most < 2**53:  # exact as floating point
        dot = lambda a, b: np.rint(a.astype("f8") @ b.astype("f8")).astype("i8")
    else:
        wide = "i8" if most < 2**63 else object
        dot = lambda a, b: a.astype(wide) @ b.astype(wide)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    bounds = dot(up, boxes[:, 1].T) + dot(down, boxes[:, 0].T)
    best = []
    for i in range(len(q)):
        heap, bound, floor = [], bounds[i], least[i]
        best.append(heap)
        todo = [(-bound[0], 0)]
        while todo:
            b, at = heapq.heappop(todo)
            if len(heap) == k:
                floor = heap[0][0] if floor is None else max(floor, heap[0][0])
            if floor is not None and -b < floor:
                break
            lo, hi, left, right = nodes[at]
            if left >= 0:
                for child in (left, right):
                    if floor is None or bound[child] >= floor:
                        heapq.heappush(todo, (-bound[child], child))
                continue
            scores = dot(x[lo:hi], q[i])
            keep = rows[lo:hi] != q_rows[i]
            if floor is not None:
                keep &= scores >= floor
            for s, v in zip(scores[keep].tolist(), ids[lo:hi][keep].tolist()):
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                elif (s, -v) > heap[0]:
                    heapq.heapreplace(heap, (s, -v))
    return best


def _matrix(data: bytes, rows: int, dim: int) -> np.ndarray:
    """Rows of ``dim`` integers of 32 or 64 bits, as the size tells."""
    return np.frombuffer(data, "i8" if len(data) == 8 * rows * dim else "i4").reshape(-1, dim)


def _searched(shards: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """query_row, query_id, vec_id and score of every pair of a shard and a block with the same (group, block, dim)."""
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(left, right):
        out = []
        if left.num_rows and right.num_rows:
            s, b = left.to_pylist()[0], right.to_pylist()[0]
            q_rows, q_ids = (np.frombuffer(b[c], "i8") for c in ("rows", "ids"))
            rows, ids = (np.frombuffer(s[c], "i8") for c in ("rows", "ids"))
            q, x, nodes = _matrix(b["vectors"], len(q_ids), b["dim"]), _matrix(s["vectors"], len(ids), s["dim"]), np.frombuffer(s["nodes"], "i4").reshape(-1, 4)
            boxes = _matrix(s["boxes"], 2 * len(nodes), s["dim"]).reshape(-1, 2, s["dim"])
            bound = dict(zip(b["bound_rows"] or [], b["bounds"] or []))
            least = [bound.get(r) for r in q_rows.tolist()]
            for r, v, heap in zip(q_rows.tolist(), q_ids.tolist(), _search(q, q_rows, least, rows, ids, x, boxes, nodes, k)):
                out += [(r, v, -i, score) for score, i in heap]
        cols = [*zip(*out)] or [()] * 4
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)

    by = ("group", "block", "dim")
    return shards.groupBy(*by).cogroup(blocks.groupBy(*by)).applyInArrow(search, "query_row long, query_id long, vec_id long, score long")


def exact_top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vectors``: vec_id and embedding; ``is_query``: a condition on vec_id. Returns query_id, rank, vec_id, score."""
    x = F.col("embedding")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & good)
    rows = as_table(rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.size(x).alias("dim"), scaled.alias("x")), "vectors")
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    if not totals["q"]:
        return empty
    n_shards, n_blocks = -(-totals["n"] // shard_rows), -(-totals["q"] // block_rows)

    def packed(df: DataFrame, groups: int, with_tree: bool) -> DataFrame:
        df = df.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("long"))
        return df.groupBy("group", "dim").applyInArrow(_packer(with_tree), PACK)

    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    shards = as_table(packed(rows, n_shards, True), "shards")
    no_bound = {"bound_rows": F.lit(None).cast("array<long>"), "bounds": F.lit(None).cast("array<long>")}
    blocks = as_table(packed(rows.where(is_query), n_blocks, False).withColumnRenamed("group", "block").drop("boxes", "nodes"), "queries")
    own = F.pmod("block", F.lit(n_shards)).cast("long")  # the shard of the first pass
    first_shards = shards.select("*", F.explode(F.filter(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>"), lambda b: F.pmod(b, F.lit(n_shards)) == F.col("group"))).alias("block"))
    first = as_table(_searched(first_shards, blocks.withColumns({"group": own, **no_bound}), k), "first")
    kth = first.groupBy("query_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("bound")).where(F.col("n") == k)
    block = F.pmod(F.xxhash64(F.col("query_row")), F.lit(n_blocks)).cast("long").alias("block")
    bounds = kth.select(block, F.struct("query_row", "bound").alias("b")).groupBy("block").agg(F.collect_list("b").alias("b"))  # the queries of a block
    bounds = bounds.select("block", F.col("b.query_row").alias("bound_rows"), F.col("b.bound").alias("bounds"))
    seeded = blocks.join(bounds, "block", "left")
    rest = seeded.withColumn("own", own).withColumn("group", numbers(n_shards)).where("group <> own").drop("own")
    others = shards.withColumn("block", numbers(n_blocks)).where(F.pmod("block", F.lit(n_shards)) != F.col("group"))
    found = first.union(_searched(others, rest, k))
    order = W.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)


SQL = f"""
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.row <> c.row AND len(q.x) = len(c.x) WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {K}"""
