"""Import queries: documents derived from parts, suppliers and lines, loaded into a store of their own in two batches.

Suppliers of the first 13 nations are the characters of the first batch, with the parts they deliver as its works; the others
and the parts that are left are the second. What the others deliver of the first batch's parts are relations across batches.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators import contract as C
from ..operators import importing as I
from ..operators.runs import Store
from ..sources.scratch import keeper, new_place
from ..sources.tables import table
from .catalogue import query

_EDGES = """
WITH e AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s, s_nationkey < 13 AS one FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
w AS (SELECT p, bool_or(one) AS one FROM e GROUP BY p), r AS (SELECT e.p, e.s, e.one, w.one AS work_one FROM e JOIN w USING (p))"""
_stores: dict = {}


def _code(n):
    return F.concat(F.lit("N"), F.chr(65 + F.floor(n / 26)), F.chr(65 + n % 26))


def _person_id(k):
    return F.concat(F.lit("realCharacter_abc_"), (1000 + F.floor(k / 1000)).cast("string"), F.lit("_"), F.lpad((k % 1000).cast("string"), 3, "0"))


def _work_id(k):
    return F.concat(F.lit("work_abc_"), (1 + F.floor(k / 1000)).cast("string"), F.lit("_"), F.lpad((k % 1000).cast("string"), 3, "0"))


def _edges(spark, d):
    """Who delivers what: (p, s, one, work_one, rel), each pair once."""
    c = F.col
    lines = table(spark, d, "lineitem").select(c("l_partkey").alias("p"), c("l_suppkey").alias("s")).distinct()
    edges = lines.join(table(spark, d, "supplier").select(c("s_suppkey").alias("s"), (c("s_nationkey") < 13).alias("one")), "s")
    return edges.withColumns({"work_one": F.bool_or("one").over(W.partitionBy("p")), "rel": F.when((c("p") + c("s")) % 3 == 0, 99).otherwise(1)})


def _people(suppliers):
    """Suppliers as characters; their own works are those of the column ``own``."""
    c, k = F.col, F.col("s_suppkey")
    name = lambda lang, text: F.struct(F.lit(lang).alias("language"), text.alias("name"))
    return suppliers.select(
        (c("s_nationkey") < 13).alias("one"), _person_id(k).alias("id"), F.lit(1).alias("characterType"), F.lit(1).alias("realSubType"), F.lit(1).alias("creativeEntityType"), (k % 4).cast("int").alias("gender"),
        _code(c("s_nationkey")).alias("countryCode"), (k % 9).cast("int").alias("field"), F.lit(None).cast("int").alias("dynasty"), (1000 + F.floor(k / 1000)).cast("int").alias("beginCentury"), (1050 + F.floor(k / 1000)).cast("int").alias("endCentury"),
        F.array(name(0, c("s_name")), name(1, F.concat("s_name", F.lit(" en")))).alias("names"), F.lit("x" * 60).alias("introduction"),
        F.transform(F.coalesce("own", F.array().cast("array<struct<p:long,rel:int>>")), lambda x: F.struct(_work_id(x["p"]).alias("workId"), x["rel"].alias("relationType"))).alias("ownWork"), k.cast("long").alias("position"),
    )


def _works(parts, edges):
    """Parts that are delivered as works, with their makers of the same batch."""
    c = F.col
    makers = edges.where("one = work_one").groupBy("p", "work_one").agg(F.sort_array(F.collect_list(F.struct("s", "rel"))).alias("makers"))
    q, genre = c("p_partkey"), (1 + c("p_partkey") % 8).cast("int")
    first, second = genre * 1000 + 1 + (q % 5).cast("int"), genre * 1000 + 6
    return parts.join(makers, parts["p_partkey"] == makers["p"]).select(
        c("work_one").alias("one"), _work_id(q).alias("workId"), c("p_name").alias("workName"), F.lit(None).cast("string").alias("originalName"), genre.alias("genre"), first.alias("subcategory"), F.array(first, second).alias("subcategories"),
        (1 + q % 2000).cast("int").alias("year"), F.when(q % 3 != 0, _code(q % 25)).alias("countryCode"), F.lit("y" * 40).alias("introduction"), F.lit(None).cast("string").alias("primaryAuthorId"),
        F.transform("makers", lambda x, i: F.struct(_person_id(x["s"]).alias("characterId"), x["rel"].alias("relationType"), i.cast("int").alias("sortOrder"))).alias("creators"), q.cast("long").alias("position"),
    )


def _documents(spark, d):
    """Characters and works of either batch, and the edges between them."""
    keep = keeper(spark)
    edges = keep(_edges(spark, d))
    own = edges.groupBy(F.col("s").alias("s_suppkey")).agg(F.sort_array(F.collect_list(F.struct("p", "rel"))).alias("own"))
    return keep(_people(table(spark, d, "supplier").join(own, "s_suppkey", "left"))), keep(_works(table(spark, d, "part"), edges)), edges


def _loaded(spark, d):
    """A store with both batches, made once a session, its runs, and the documents."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _stores:
        documents = people, works, _ = _documents(spark, d)
        store = Store(spark, new_place(spark, "store"))
        nations = table(spark, d, "nation")
        I.create(store, nations.select(F.col("n_nationkey").cast("int").alias("id"), _code(F.col("n_nationkey")).alias("code")))
        part = lambda df, one: df.where(F.col("one") if one else ~F.col("one")).drop("one")
        runs = [I.import_batch(store, f"batch{i}", part(people, one), part(works, one)) for i, one in ((1, True), (2, False))]
        _stores[key] = store, runs, documents
    return _stores[key]


@query(_EDGES + " SELECT p AS l_partkey, s AS l_suppkey, CASE WHEN (p + s) % 3 = 0 THEN 99 ELSE 1 END AS relation_type, (row_number() OVER (PARTITION BY p ORDER BY one <> work_one, s) - 1)::INTEGER AS sort_order FROM r")
def batch_import(spark, d):
    """Relations as they stand after two imports: creators in their own order, those of the later batch behind them."""
    store, _, _ = _loaded(spark, d)
    c = F.col
    parts = table(spark, d, "part").select("p_partkey", I.stable_id("work", _work_id(c("p_partkey"))).alias("work_id"))
    people = table(spark, d, "supplier").select("s_suppkey", I.stable_id("character", _person_id(c("s_suppkey"))).alias("character_id"))
    rows = store.read("work_creator").join(parts, "work_id").join(people, "character_id")
    return rows.select(c("p_partkey").alias("l_partkey"), c("s_suppkey").alias("l_suppkey"), "relation_type", "sort_order")


_PER_RUN = """SELECT one, kind, name, coalesce(n, 0) AS n FROM (SELECT unnest([true, false]) AS one) CROSS JOIN (SELECT unnest(['rows', 'missing']) AS kind)
CROSS JOIN (SELECT unnest(['character', 'character_name', 'real_attribute', 'work', 'work_creator', 'work_subcategory']) AS name) LEFT JOIN (
SELECT s_nationkey < 13 AS one, 'character' AS name, count(*) AS n FROM supplier GROUP BY 1 UNION ALL SELECT s_nationkey < 13, 'real_attribute', count(*) FROM supplier GROUP BY 1 UNION ALL
SELECT s_nationkey < 13, 'character_name', 2 * count(*) FROM supplier GROUP BY 1 UNION ALL SELECT one, 'work', count(*) FROM w GROUP BY 1 UNION ALL SELECT one, 'work_subcategory', 2 * count(*) FROM w GROUP BY 1 UNION ALL
SELECT one, 'work_creator', count(*) FROM r GROUP BY 1) USING (one, name)"""


@query(_EDGES + f", t AS ({_PER_RUN}) SELECT CASE WHEN one THEN 1 ELSE 2 END AS batch, kind, name, CASE WHEN kind = 'rows' THEN n ELSE 0 END AS n FROM t UNION ALL SELECT b, 'check', x, 0 FROM (SELECT unnest([1, 2]) AS b), (SELECT unnest(["
       "'invalidNameLanguage', 'duplicateStandardNames', 'invalidRealSubtype', 'chinaWrongCountry', 'invalidCreativeEntityType', 'invalidField', 'invalidDynasty', 'chinaMissingDynasty', 'invalidGender', 'duplicateRelations', 'virtualCreators', 'invalidRelationGenre', 'invalidSubcategoryGenre', 'invalidTagGenre', 'invalidPrimaryTag', 'missingOrDuplicatePrimaryTag', 'brokenRelations']) AS x) "
       "UNION ALL SELECT b, 'passed', 'passed', 1 FROM (SELECT unnest([1, 2]) AS b)")  # fmt: skip
def import_status(spark, d):
    """What the status of either run says: rows there and missing, all checks, passed."""
    store, runs, _ = _loaded(spark, d)
    kind = F.when(F.col("kind") == "passed", "passed").otherwise(F.col("name"))
    parts = [I.run_status(store, run["run"]).select(F.lit(i + 1).alias("batch"), "kind", kind.alias("name"), "n") for i, run in enumerate(runs)]
    return parts[0].union(parts[1])


@query(_EDGES + """, new AS (SELECT s_suppkey AS s FROM supplier WHERE s_nationkey % 2 = 0)
SELECT * FROM (SELECT 'natural_key' AS problem, 2 * (SELECT count(*) FROM new) AS n UNION ALL SELECT 'country_unknown', (SELECT count(*) FROM new WHERE s % 2 = 0) UNION ALL
SELECT 'work_unknown', (SELECT count(*) FROM new) UNION ALL SELECT 'relation_genre', (SELECT count(*) FROM e JOIN new USING (s) WHERE 1 + p % 8 <> 3)) WHERE n > 0""")
def import_refused(spark, d):
    """Suppliers of every other nation under new ids, with relations to works that are there and to one that isn't: what speaks against it."""
    store, _, (people, works, _) = _loaded(spark, d)
    k = F.col("position")
    suppliers = table(spark, d, "supplier").where("s_nationkey % 2 = 0").select(F.col("s_suppkey").cast("long").alias("position"))
    item = lambda w, r: F.struct(w.alias("workId"), F.lit(r).alias("relationType"))
    again = people.join(suppliers, "position").withColumns({
        "id": F.regexp_replace("id", "_abc_", "_xyz_"), "countryCode": F.when(k % 2 == 0, "ZZZ").otherwise(F.col("countryCode")),
        "ownWork": F.concat(F.transform("ownWork", lambda w: item(w["workId"], 14)), F.array(item(F.lit("work_abc_0_000"), 1))),
    })
    snapshot = store.snapshot()[1]
    found = I.problems(*I.kept_documents(again.drop("one"), works.drop("one").limit(0), keeper(spark)), lambda t: store._at(snapshot, t))
    return found.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))
