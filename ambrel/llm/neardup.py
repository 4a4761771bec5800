"""Near-duplicate classes by BagMinHash signatures, banding and exact verification.

Texts are multisets of shingles (five words; words are runs of anything but
ASCII white space), similarity is the weighted Jaccard coefficient
sum(min)/sum(max) of the multiplicities. Texts belong to one class if a chain
of texts, each at 0.8 or more to the next, connects them.

1. Exact copies collapse to one text (two 64-bit hashes).
2. A signature has M components. An element of multiplicity w owns the Poisson
   process on levels [0, w) x time; levels are discretised into the dyadic
   intervals [0,1), [1,2), [2,4), ...: one process for each, whose rate is its
   length; of the interval that w cuts, only points below level w count. A
   component keeps the earliest point that falls to it. As a text with larger
   weights sees a superset of points, two texts agree in a component with
   probability equal to their weighted Jaccard coefficient. Processes run in
   step, and each stops once its next point is later than all the text's
   components: O(elements + M log M) points.
3. BANDS bands of ROWS components are bucket keys. At 0.8 two texts share none
   with probability (1 - 0.8**5)**30 < 1e-5.
4. In a bucket every text is compared with a hub, the text that has the most
   company over all its buckets (in a group of copies, the one they stem from).
   Verified links give components. In a bucket that still holds several, the texts
   outside its largest component are compared with all texts of other components,
   by finer sketches (FINE components, made for these texts alone), block by
   block; only pairs whose estimate is at most MARGIN (four deviations) below the
   threshold go on. Nothing is capped, and pairs are never all made.
5. Every pair is verified on the multisets of the two whole texts. A hub's pairs are
   dealt in groups of HUB_ROWS, each with the hub's text.

A bucket with more than a thousandth of all rows is joined by broadcast (there are
fewer than a thousand such), the others by shuffle.

Components come from alternating star contractions over tables in the shared
folder. Null texts are classes of their own; texts under five words (empty ones
too) match only their exact copies; texts of any length are read whole. Rows may
repeat and doc_id be null: rows carry numbers of their own, and a class is named by
its least doc_id, null only if all are null. A similarity of exactly the threshold
links; of hubs with equal company the smaller number is taken. An empty table gives
no rows. Only doc_id and text are read; deduplicate() returns all columns as they
are, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table, in_pieces, join_skewed

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 30, 5
M = BANDS * ROWS
PIECE, BLOCK, HUB_ROWS = 1_500_000, 1024, 256
#: Sketches estimate the similarity with a deviation of (0.8 * 0.2 / FINE) ** 0.5 = 0.014 at 0.8.
FINE, MARGIN = 800, 0.06
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTES = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 64, 256, dtype="u8")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64."""

    up = down = np.ones(1, "u8")

    @classmethod
    def to(cls, n: int):
        if n > len(cls.up):
            base = 0x5851F42D4C957F2D
            cls.up, cls.down = (np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n + n // 2, b, "u8")]), dtype="u8") for b in (base, pow(base, -1, 1 << 64)))
        return cls.up[:n], cls.down[:n]


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit hash of every shingle of every text, in order."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(data) + b"\n", "u1")
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype("i1")))
    starts, ends = edge[::2], edge[1::2]
    if len(starts) < SHINGLE:
        return np.empty(0, "i8"), np.empty(0, "u8")
    up, down = _Powers.to(len(raw))
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(_BYTES[raw] * up, dtype="u8")])
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype("u8") * _PRIME)
    doc = np.searchsorted(np.cumsum([len(d) + 1 for d in data]), starts, "right")
    n = len(words) - SHINGLE + 1
    value = np.zeros(n, "u8")
    for j in range(SHINGLE):
        value = value * np.uint64(0xD1342543DE82EF95) + words[j : j + n]
    inside = doc[:n] == doc[SHINGLE - 1 :]
    return doc[:n][inside], mix(value[inside])


def bag_signatures(doc: np.ndarray, shingle: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """The signature (n_docs, m) of 32-bit codes; rows of texts without shingles are meaningless."""
    key = np.sort((doc.astype("u8") << np.uint64(48)) | (shingle >> np.uint64(16)))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, "i8")
    weight = np.diff(np.concatenate([new, [len(key)]]))
    owner, seed = (key[new] >> np.uint64(48)).astype("i8"), mix(key[new] << np.uint64(16))
    who, top, low = [np.arange(len(new))], [np.ones(len(new))], [np.zeros(len(new))]
    level = 1
    while (has := np.flatnonzero(weight > level)).size:  # the interval [level, 2 level)
        who.append(has)
        top.append(np.full(len(has), level * 1.0))
        low.append(np.full(len(has), level * 1.0))
        level *= 2
    who, length, low = np.concatenate(who), np.concatenate(top), np.concatenate(low)
    text, limit = owner[who], weight[who].astype("f8")
    seed = mix(seed[who] + (low.astype("u8") + np.uint64(1)) * _PRIME)
    partial = low + length > limit
    time = np.zeros(len(who))
    sig = np.full(n_docs * m, np.inf)
    latest = np.full(n_docs, np.inf)
    code = np.arange(len(who))
    turn = 0
    while len(code):
        turn += 1
        h = mix(seed[code] + np.uint64(turn * int(_PRIME) & (1 << 64) - 1))
        time[code] -= np.log(((h >> np.uint64(11)).astype("f8") + 0.5) * 2.0**-53) / length[code]
        early = time[code] < latest[text[code]]
        code, h = code[early], h[early]
        h2 = mix(h + _PRIME)
        slot = text[code] * m + (((h2 >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype("i8")
        ok = slice(None)
        if partial[code].any():
            place = low[code] + length[code] * ((h2 & np.uint64(0xFFFFFFFF)).astype("f8") * 2.0**-32)
            ok = place < limit[code]
        np.minimum.at(sig, slot[ok], time[code][ok])
        if turn < 8 or turn % 4 == 0:
            some = np.unique(text[code]) if turn >= 8 else slice(None)
            latest[some] = sig.reshape(n_docs, m)[some].max(1)
        code = code[time[code] < latest[text[code]]]
    # single precision: a logarithm may differ in its last bit between machines or vector lengths
    return mix(sig.astype("f4").view("u4").astype("u8")).reshape(n_docs, m)


def band_keys(sig: np.ndarray) -> np.ndarray:
    value = np.zeros((len(sig), BANDS), "u8")
    for r in range(ROWS):
        value = value * np.uint64(0xD1342543DE82EF95) + sig[:, r::ROWS] + np.uint64(1)
    return mix(value + np.arange(BANDS, dtype="u8") * _PRIME).view("i8")


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2 (the text's hashes; null without text), n (shingles), bands (array<long>, empty without shingles)."""
    keyed = docs.select("doc_id", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("k1"), F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(7), F.col("text"))).alias("k2"), "text")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n_all, bands_all = [], []
            for lo, hi in in_pieces(texts, PIECE):
                for a in range(lo, hi, 30_000):
                    b = min(hi, a + 30_000)
                    doc, values = shingles(texts[a:b])
                    n = np.bincount(doc, minlength=b - a)
                    bands = band_keys(bag_signatures(doc, values, b - a, M))
                    n_all += n.tolist()
                    bands_all += [row if k else [] for k, row in zip(n.tolist(), bands)]
            out = [batch.column(c) for c in ("doc_id", "k1", "k2")] + [pa.array(n_all, pa.int64()), pa.array(bands_all, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "k1", "k2", "n", "bands"])

    return keyed.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, k1 long, k2 long, n long, bands array<long>")


def _bag(text: str) -> np.ndarray:
    """The multiset of a text's shingles as a sorted set: later occurrences get hashes of their own."""
    _, values = shingles([text])
    values = np.sort(values)
    if len(values) > 1 and (same := values[1:] == values[:-1]).any():
        run = np.arange(len(values)) - np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(values)), 0))
        values = np.sort(np.where(run > 0, mix(values + run.astype("u8") * _PRIME), values))
    return values


def bag_similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 0.0


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (id, hub) whose texts reach the threshold."""

    def run(batches):
        last, bag = None, None
        for batch in batches:
            ids, hubs = batch.column("id").to_pylist(), batch.column("hub").to_pylist()
            mine, other = batch.column("text"), batch.column("hub_text")
            keep = []
            for i, h in enumerate(hubs):
                if h != last:
                    last, bag = h, _bag(other[i].as_py())
                keep.append(bag_similarity(_bag(mine[i].as_py()), bag) >= threshold)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(c, keep) if k], pa.int64()) for c in (ids, hubs)], ["id", "hub"])

    groups = F.ceil(F.col("of_hub") / HUB_ROWS).cast("int")
    dealt = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("of_hub")).select("hub", "of_hub", groups.alias("groups"))
    hubs = dealt.join(texts.select(F.col("id").alias("hub"), F.col("text").alias("hub_text")), "hub")
    hubs = hubs.select("hub", "hub_text", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("deal"))
    counted = join_skewed(pairs, dealt, "hub", "of_hub", pairs.count())
    mine = counted.select("id", "hub", F.pmod(F.xxhash64("id"), F.col("groups")).cast("int").alias("deal")).join(texts, "id")
    joined = mine.join(hubs, ["hub", "deal"]).sortWithinPartitions("hub", "deal")
    return joined.select("id", "hub", "text", "hub_text").mapInArrow(run, "id long, hub long")


def components(edges: DataFrame) -> DataFrame:
    """id and comp, the least id of its component, for every id in ``edges`` (id, hub): alternating large and small stars."""
    edges = as_table(edges.select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).where("a > b").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).where("a > b").distinct()
        edges = as_table(small, "stars")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if seen == (state["n"], state["s"]):
            return edges.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())
        seen = (state["n"], state["s"])


def _similar_length(a: str, b: str, threshold: float):
    return F.least(F.col(a), F.col(b)) >= threshold * F.greatest(F.col(a), F.col(b))


def _compared(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows with their hashes, the distinct texts (id: the row that stands for them), and the components of those with links."""
    rows = as_table(signatures(docs).withColumn("row", F.monotonically_increasing_id()), "signatures")
    firsts = rows.where("k1 is not null").groupBy("k1", "k2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")).alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    firsts = as_table(firsts.select("k1", "k2", F.col("first.row").alias("id"), F.col("first.doc_id").alias("doc_id"), "n", "bands"), "texts")
    band = firsts.select("id", "n", F.posexplode("bands").alias("k", "b"))
    many = as_table(band.groupBy("b").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    total = many.agg(F.sum("size").alias("n")).first()["n"] or 0
    shared = join_skewed(band, many, "b", "size", total)
    score = shared.groupBy("id").agg(F.sum("size").alias("score"))
    shared = as_table(shared.join(score, "id").select("b", "k", "id", "n", "size", "score"), "buckets")
    return rows, firsts, _linked(docs, firsts, shared, threshold)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_class (least doc_id with the same text) and class_id (least doc_id of the near-duplicate class) of every row."""
    rows, firsts, comps = _compared(docs, threshold)
    named = firsts.select("id", "k1", "k2", F.col("doc_id").alias("text_class")).join(comps, "id", "left")
    least = named.groupBy(F.coalesce("comp", "id").alias("comp")).agg(F.min("text_class").alias("class_id"))
    named = named.withColumn("comp", F.coalesce("comp", "id")).join(least, "comp").select("k1", "k2", "text_class", "class_id")
    out = rows.select("doc_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    return out.select("doc_id", F.when(F.col("k1").isNull(), F.col("doc_id")).otherwise(F.col("text_class")).alias("text_class"), F.when(F.col("k1").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def _linked(docs: DataFrame, firsts: DataFrame, shared: DataFrame, threshold: float) -> DataFrame:
    """id and comp of the texts with links."""
    wanted = shared.select("id").distinct().join(firsts.select("id", "doc_id", "k1", "k2"), "id")
    source = docs.select("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), F.col("text")).alias("k2"), "text").where("text is not null")
    on = F.col("w.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("w.k1") == F.col("s.k1")) & (F.col("w.k2") == F.col("s.k2"))
    texts = source.alias("s").join(wanted.alias("w"), on).select("id", "text").groupBy("id").agg(F.first("text").alias("text"))
    texts = as_table(texts, "bodies")

    rows = shared.count()
    hub = F.max(F.struct("score", (-F.col("id")).alias("i"), "n")).alias("h")
    hubs = shared.groupBy("b").agg(hub, F.count(F.lit(1)).alias("size")).select("b", "size", (-F.col("h.i")).alias("hub"), F.col("h.n").alias("hub_n"))
    tried = join_skewed(shared.drop("size"), as_table(hubs, "hubs"), "b", "size", rows).where((F.col("id") != F.col("hub")) & _similar_length("n", "hub_n", threshold))
    tried = as_table(tried.select("id", "hub").distinct(), "pairs")
    links = as_table(_verified(tried, texts, threshold), "links")
    comps = as_table(components(links), "components")

    marked = as_table(shared.select("b", "k", "id", "n").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id")), "marked")
    parts = marked.groupBy("b", "comp").agg(F.count(F.lit(1)).alias("m"))
    several = parts.groupBy("b").agg(F.sum("m").alias("size"), F.max(F.struct("m", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    several = as_table(several.select("b", "size", F.col("top.comp").alias("main"), (F.col("size") - F.col("top.m")).alias("strays")), "several")
    mixed = as_table(join_skewed(marked, several, "b", "size", rows), "mixed")
    sources = mixed.select("id").distinct().join(texts, "id").join(firsts.select("id", "bands"), "id")
    pairs = _across(mixed, as_table(_sketches(sources), "sketches"), threshold)
    known = tried.union(tried.select(F.col("hub").alias("id"), F.col("id").alias("hub")))
    pairs = as_table(pairs.join(known, ["id", "hub"], "left_anti"), "pairs")
    more = as_table(_verified(pairs, texts, threshold), "links")
    if not more.limit(1).count():
        return comps
    return as_table(components(comps.select("id", F.col("comp").alias("hub")).union(more)), "components")


def _sketches(texts: DataFrame) -> DataFrame:
    """id, tags (32 bits of each band) and sketch (8 bits of FINE components) of id, text and bands."""

    def run(batches):
        for batch in batches:
            bodies = batch.column("text").to_pylist()
            tags = [np.array(x, "i8").astype("<u4").tobytes() for x in batch.column("bands").to_pylist()]
            rows = []
            for lo, hi in in_pieces(bodies, PIECE // 4):
                doc, values = shingles(bodies[lo:hi])
                rows += [x.tobytes() for x in (bag_signatures(doc, values, hi - lo, FINE) & np.uint64(255)).astype("u1")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(tags, pa.binary()), pa.array(rows, pa.binary())], ["id", "tags", "sketch"])

    return texts.select("id", "text", "bands").mapInArrow(run, "id long, tags binary, sketch binary")


def _across(rows: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Pairs (id, hub) across components within a bucket whose sketches leave the threshold possible.

    ``rows``: b, k, id, n, comp, size, main (the bucket's largest component) and strays (the number of texts outside it).
    Strays are dealt into blocks of about BLOCK and meet all texts of the bucket, dealt into blocks too; a task holds two
    blocks, compares their sketches as arrays and gives out only the pairs that may reach the threshold, each in the first
    band that it shares. Two strays are compared once, with the smaller id as the stray.
    """
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    deal = lambda c: F.pmod(F.xxhash64("id"), blocks(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    strays = rows.where("comp <> main").select("b", "k", deal("strays").alias("i"), every("size").alias("j"), F.lit(0).alias("side"), "id", "n", "comp", "main")
    others = rows.select("b", "k", every("strays").alias("i"), deal("size").alias("j"), F.lit(1).alias("side"), "id", "n", "comp", "main")
    dealt = strays.union(others).join(sketches, "id")
    least = threshold - MARGIN
    inputs = ("side", "id", "n", "comp", "main", "tags", "sketch")

    def close(group, held):
        k = group[1]
        side, ids, sizes, comps, mains, tags, sketch = zip(*held)
        ids, sizes, comps = (np.array(x, "i8") for x in (ids, sizes, comps))
        tags, sketch = np.frombuffer(b"".join(tags), "<u4").reshape(len(held), -1), np.frombuffer(b"".join(sketch), "u1").reshape(len(held), -1)
        main, other = mains[0], np.flatnonzero(np.array(side) == 1)
        for x in np.flatnonzero(np.array(side) == 0).tolist():
            ok = (comps[other] != comps[x]) & ((comps[other] == main) | (ids[other] > ids[x]))
            ok &= np.minimum(sizes[other], sizes[x]) >= threshold * np.maximum(sizes[other], sizes[x])
            at = other[ok]
            if at.size:
                at = at[~(tags[at, :k] == tags[x, :k]).any(1)]
                at = at[(sketch[at] == sketch[x]).mean(1) >= least]
                yield from ((max(ids[x], y), min(ids[x], y)) for y in ids[at].tolist())

    def run(batches):
        group, held = None, []
        emit = lambda found: pa.RecordBatch.from_arrays([pa.array([int(p[c]) for p in found], pa.int64()) for c in (0, 1)], ["id", "hub"])
        for batch in batches:
            found = []
            for *key, a, b, c, d, e, f, g in zip(*(batch.column(c).to_pylist() for c in ("b", "k", "i", "j", *inputs))):
                if key != group:
                    if held:
                        found += close(group, held)
                    group, held = key, []
                held.append((a, b, c, d, e, f, g))
            if found:
                yield emit(found)
        if held and (found := [*close(group, held)]):
            yield emit(found)

    dealt = dealt.select("b", "k", "i", "j", *inputs).repartition("b", "i", "j").sortWithinPartitions("b", "i", "j")
    return dealt.mapInArrow(run, "id long, hub long")


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, with the least doc_id (null only if all are); rows without text all stay.

    Rows are told apart by doc_id and text, so rows with different texts may share a doc_id.
    """
    rows, firsts, comps = _compared(docs, threshold)
    rows = rows.where("k1 is not null").select("doc_id", "k1", "k2")
    classes = firsts.select("id", "doc_id").join(comps, "id", "left").groupBy(F.coalesce("comp", "id").alias("comp"))
    heads = classes.agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "id")).alias("head")).select(F.col("head.id").alias("id"))
    heads = firsts.join(heads, "id", "left_semi").select("doc_id", "k1", "k2")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["k1"] == b["k1"]) & (a["k2"] == b["k2"])
    others = as_table(rows.join(heads, same(rows, heads), "left_anti").distinct(), "others")
    there = F.col("text").isNotNull()
    hashed = docs.withColumns({"__d_k1": F.when(there, F.xxhash64("text")), "__d_k2": F.when(there, F.xxhash64(F.lit(7), F.col("text")))})
    out = hashed.join(others, hashed["doc_id"].eqNullSafe(others["doc_id"]) & (hashed["__d_k1"] == others["k1"]) & (hashed["__d_k2"] == others["k2"]), "left_anti")
    if not rows.groupBy("doc_id", "k1", "k2").count().where("count > 1").limit(1).count():
        return out.select(*docs.columns)
    out = as_table(out.withColumn("__d_row", F.monotonically_increasing_id()), "numbered")
    first = out.where("text is not null").groupBy("doc_id", "__d_k1", "__d_k2").agg(F.min("__d_row").alias("__d_row")).select("__d_row")
    return out.where("text is null").union(out.join(first, "__d_row", "left_semi").select(*out.columns)).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
