"""Patches and deletes over stores that are made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contract as C
from ..operators import deletes as D
from ..operators import enrichment as P
from ..operators import enums as E
from ..operators import importing as I
from ..operators.runs import Store
from ..sources.scratch import keeper, new_place
from ..sources.tables import table
from .catalogue import query
from .imports import _EDGES, _code, _edges, _people, _person_id, _work_id, _works


def _entities(spark, d):
    """A store of all suppliers and the parts they deliver; relations are the works' own, so nobody's own works are listed."""
    none = F.lit(None).cast("array<struct<p:long,rel:int>>")
    people, works = _people(table(spark, d, "supplier").withColumn("own", none)), _works(table(spark, d, "part"), _edges(spark, d))
    people, works = I.kept_documents(people.drop("one"), works.drop("one"), keeper(spark))
    store = Store(spark, new_place(spark, "store"))
    country = table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("id"), _code(F.col("n_nationkey")).alias("code"))
    rows = I.tables_of(people, works, country, 1)
    store.commit(lambda read: rows | {"country": country})
    return store


def _relations(rows, person, work, relation):
    """A row's relation, with either reference as a struct."""
    ref = lambda fields, given: F.struct(*[F.lit(None).cast(k).alias(n) if n not in given else given[n].cast(k).alias(n) for n, k in fields])
    p, w = [("newId", "string"), ("name", "string"), ("countryCode", "string"), ("field", "int")], [("newId", "string"), ("workName", "string"), ("countryCode", "string"), ("genre", "int"), ("year", "int")]
    return rows.select("position", ref(p, person).alias("characterRef"), ref(w, work).alias("workRef"), relation.cast("int").alias("relationType"), F.lit(7).alias("sortOrder"), (F.col("position") % 2 == 0).alias("primaryAuthor"))


def _work_ref(k):
    return {"workName": F.concat(F.lit(" "), F.col("p_name")), "genre": 1 + k % 8, "year": 1 + k % 2000, "countryCode": F.when(k % 3 != 0, _code(k % 25))}


def _none(spark, schema):
    return spark.createDataFrame([], " ".join(schema.split()))


_THERE = _EDGES + """, t AS (SELECT p_partkey AS p, p_name, 1 + p_partkey % 8 AS g, 1 + p_partkey % 2000 AS y, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey % 25 END AS c FROM part),
there AS (SELECT t.* FROM t JOIN w USING (p) WHERE c IS NOT NULL), hits AS (SELECT t.p, count(there.p) AS n, any_value(there.p) AS q FROM t LEFT JOIN there USING (p_name, g, y, c) GROUP BY t.p)"""


@query(_THERE + """
SELECT problem, count(*) AS n FROM (SELECT CASE WHEN c IS NULL THEN 'work_lacks_field' WHEN n = 0 THEN 'work_none' WHEN n > 1 THEN 'work_many' WHEN g <> 3 THEN 'relation_genre' END AS problem FROM t JOIN hits USING (p) UNION ALL
SELECT CASE p % 5 WHEN 0 THEN 'character_none' WHEN 1 THEN 'character_unknown_new' WHEN 2 THEN 'character_lacks_field' END FROM t WHERE p % 5 < 3) WHERE problem IS NOT NULL
AND problem <> 'relation_genre' GROUP BY problem UNION ALL SELECT 'relation_genre', count(*) FROM t JOIN hits USING (p) WHERE n = 1 AND c IS NOT NULL AND g <> 3 AND p % 5 >= 3 HAVING count(*) > 0""")
def patch_problems(spark, d):
    """Every part asked for by name, country, genre and year, with a character that is there or not: what stops the patch."""
    store, k = _entities(spark, d), F.col("p_partkey")
    first = table(spark, d, "supplier").agg(F.min(F.struct("s_suppkey", "s_name", "s_nationkey")).alias("s"))
    rows = table(spark, d, "part").select("p_partkey", "p_name", k.cast("long").alias("position")).join(F.broadcast(first))  # one row
    known = k % 5 != 1
    person = {"newId": F.when(~known, "nobody"), "name": F.when(k % 5 == 0, "no such name").otherwise(F.col("s.s_name")), "countryCode": F.when(k % 5 != 2, _code(F.col("s.s_nationkey"))), "field": F.col("s.s_suppkey") % 9}
    relations = _relations(rows, person, _work_ref(k), F.lit(14))
    snapshot = store.snapshot()[1]
    found = P.problems(_none(spark, C.CHARACTER), _none(spark, C.WORK), relations, lambda t: store._at(snapshot, t))
    return found.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@query(_THERE + """, one AS (SELECT t.p, hits.q FROM t JOIN hits USING (p) WHERE n = 1 AND c IS NOT NULL)
SELECT q AS p_partkey, 'customer' AS kind, 1 + p % (SELECT max(c_custkey) FROM customer) AS key, 7 AS sort_order, (p % 2 = 0) AS is_author FROM one""")
def patch_apply(spark, d):
    """Customers come as new characters, each part that matches once gets one of them: the relations and authors as they then stand."""
    store, c, k = _entities(spark, d), F.col, F.col("p_partkey")
    customers = table(spark, d, "customer")
    top = customers.agg(F.max("c_custkey").alias("top"))
    new_id = lambda x: F.concat(F.lit("new_"), x.cast("string"))
    name = F.struct(F.lit(1).alias("language"), F.col("c_name").alias("name"))
    given = {"id": new_id(c("c_custkey")), "gender": F.lit(1), "realSubType": F.lit(1), "creativeEntityType": F.lit(1), "field": F.lit(1), "countryCode": _code(c("c_nationkey")), "names": F.array(name), "position": c("c_custkey").cast("long")}
    shape = _none(spark, C.CHARACTER).schema
    people = customers.select(*[given[f.name].cast(f.dataType).alias(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in shape])
    parts = table(spark, d, "part").select("p_partkey", "p_name", k.cast("long").alias("position")).join(F.broadcast(top))  # one row
    relations = _relations(parts, {"newId": new_id(1 + k % c("top"))}, _work_ref(k), F.lit(99))
    snapshot = store.snapshot()[1]
    good = P.matched(relations, people, _none(spark, C.WORK), lambda t: store._at(snapshot, t)).where("character_problem is null and work_problem is null").select(*relations.columns)
    P.apply_patch(store, "patch", people, _none(spark, C.WORK), good)
    works = table(spark, d, "part").select("p_partkey", I.stable_id("work", _work_id(k)).alias("work_id"))
    keys = customers.select(c("c_custkey").alias("key"), I.stable_id("character", new_id(c("c_custkey"))).alias("character_id"))
    author = store.read("work").select(c("id").alias("work_id"), c("auth_character_id").alias("author"))
    rows = store.read("work_creator").join(keys, "character_id").join(works, "work_id").join(author, "work_id")
    return rows.select("p_partkey", F.lit("customer").alias("kind"), "key", "sort_order", F.coalesce(c("author") == c("character_id"), F.lit(False)).alias("is_author"))


REFERENCES = [("nation", "n_regionkey", "region"), ("customer", "c_nationkey", "nation"), ("supplier", "s_nationkey", "nation"), ("orders", "o_custkey", "customer"), ("lineitem", "l_orderkey", "orders"), ("lineitem", "l_suppkey", "supplier"), ("lineitem", "l_partkey", "part")]


@query("""
WITH r AS (SELECT max(r_regionkey) AS k FROM region), n AS (SELECT n_nationkey AS k FROM nation, r WHERE n_regionkey = r.k), c AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey IN (SELECT k FROM n)),
s AS (SELECT s_suppkey AS k FROM supplier WHERE s_nationkey IN (SELECT k FROM n)), o AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey IN (SELECT k FROM c)),
l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT k FROM o) OR l_suppkey IN (SELECT k FROM s)),
g AS (SELECT 'region' AS "table", 1 AS gone, (SELECT count(*) FROM region) AS n UNION ALL SELECT 'nation', (SELECT count(*) FROM n), (SELECT count(*) FROM nation) UNION ALL SELECT 'customer', (SELECT count(*) FROM c), (SELECT count(*) FROM customer) UNION ALL
SELECT 'supplier', (SELECT count(*) FROM s), (SELECT count(*) FROM supplier) UNION ALL SELECT 'orders', (SELECT count(*) FROM o), (SELECT count(*) FROM orders) UNION ALL SELECT 'lineitem', (SELECT count(*) FROM l), (SELECT count(*) FROM lineitem))
SELECT "table", gone, n AS before, n - gone AS after, n AS restored, 0 AS orphans FROM g""")
def cascade_delete(spark, d):
    """A region goes with all that refers to it: counted first, deleted as one commit, no orphans left, and put back again."""
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "orders": "o_orderkey", "part": "p_partkey"}
    columns = {t: [c for x, c, _ in REFERENCES if x == t] for t in [*keys, "lineitem"]}
    number = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    tables = {t: table(spark, d, t).select((F.col(keys[t]) if t in keys else number).cast("long").alias("id"), *cs) for t, cs in columns.items()}
    store, keep = Store(spark, new_place(spark, "store")), keeper(spark)
    store.commit(lambda read: tables)
    region = tables["region"].agg(F.max("id").alias("id"))
    known = {}
    gone = D.cascade(store, "region", region, REFERENCES, keep, known=known)["rows"]
    before = D.counts(store.read, gone)
    done = D.cascade(store, "region", region, REFERENCES, keep, execute=True, known=known)
    left = D.counts(store.read, gone).withColumnRenamed("n", "after")
    lost = [store.read(child).join(store.read(parent).select(F.col("id").alias(column)), column, "left_anti").select(F.lit(child).alias("table")) for child, column, parent in REFERENCES]
    orphans = lost[0]
    for x in lost[1:]:
        orphans = orphans.union(x)
    orphans = keep(orphans.groupBy("table").agg(F.count(F.lit(1)).alias("o")))
    left = keep(left)
    store.rollback(done["run"])
    restored = D.counts(store.read, gone).withColumnRenamed("n", "restored")
    told = spark.createDataFrame([(t, gone[t] if gone[t] == done["rows"][t] else -1) for t in gone], "table string, gone long")  # a row a table
    rows = told.join(before.withColumnRenamed("n", "before"), "table").join(left, "table").join(restored, "table").join(orphans, "table", "left")
    return rows.select("table", "gone", "before", "after", "restored", F.coalesce("o", F.lit(0)).alias("orphans"))


@query("""
WITH k AS (SELECT DISTINCT p_size AS n FROM part), f AS (
SELECT 'size' AS enum, n::VARCHAR AS code, 'code' AS source, 'missing' AS fault FROM k WHERE n % 7 = 0 UNION ALL SELECT 'size', (n + 100)::VARCHAR, 'code', 'unknown' FROM k WHERE n % 7 = 0 UNION ALL
SELECT 'size', n::VARCHAR, 'prompt', 'missing' FROM k WHERE n % 5 = 0 UNION ALL SELECT 'size', (n + 200)::VARCHAR, 'prompt', 'unknown' FROM k WHERE n % 5 = 0 UNION ALL
SELECT 'kind', (CASE WHEN n % 7 = 0 THEN n + 100 ELSE n END) || ':' || (n % 4), 'code', 'unknown' FROM k WHERE n % 7 = 0 UNION ALL SELECT 'kind', n || ':' || (n % 4), 'code', 'missing' FROM k WHERE n % 7 = 0 UNION ALL
SELECT DISTINCT 'size', q::VARCHAR, 'table', 'unknown' FROM (SELECT (l_quantity * 2)::INT AS q FROM lineitem) WHERE q NOT IN (SELECT n FROM k)) SELECT * FROM f""")
def enum_contract(spark, d):
    """Parts' sizes as program code, a document and a column of lines state them, some wrongly: every difference."""
    n, c = F.col("n"), F.col
    sizes = keeper(spark)(table(spark, d, "part").select(c("p_size").alias("n")).distinct())
    expected = sizes.select(F.lit("size").alias("enum"), n.cast("string").alias("code")).union(sizes.select(F.lit("kind"), F.concat_ws(":", n, n % 4)))
    said = F.when(n % 7 == 0, n + 100).otherwise(n)
    lines = lambda text, end: F.array_join(F.sort_array(F.collect_list(text)), end)
    code = sizes.agg(F.concat(F.lit("enum SizeEnum { "), lines(F.format_string('S_%d(%d, "x")', said, said), ", "), F.lit("; private final int key; boolean fits = switch (size) { "), lines(F.format_string("case S_%d -> kind == %d;", said, n % 4), " "), F.lit(" }; }")).alias("t"))
    prompt = sizes.agg(F.concat(F.lit("## 1. Sizes\n"), lines(F.format_string("- `%d` of parts", F.when(n % 5 == 0, n + 200).otherwise(n)), "\n"), F.lit("\n## 2. End")).alias("t"))
    names = E.constants(c("t"), "SizeEnum")
    used = table(spark, d, "lineitem").select((c("l_quantity") * 2).cast("int").alias("q")).distinct()
    found = [
        E.rows(code, "code", "size", F.transform(names, lambda x: x["code"])), E.pairs(code, "code", "kind", names, E.cases(c("t"), "boolean fits = switch (size)", "kind"), sizes.select((n % 4).alias("value"))),
        E.rows(prompt, "prompt", "size", E.listed(c("t"), "## 1.", "## 2.")), E.rows(used, "table", "size", F.array("q")),
    ]
    return E.faults(expected, found, ["code/size", "code/kind", "prompt/size"], ["table"])
