"""Queries over the driver's tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import scalar as S
from ..operators import evaluation as E
from ..operators import names as N
from ..operators import relational as R
from ..operators import runs as G
from ..operators import scoring as K
from ..sources import texts as X
from ..sources.scratch import keeper, new_place
from ..sources.tables import table
from ..streaming import events as V

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}
TRAITS = ["click", "error", "purchase", "signup", "view"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT c_custkey, (('0x' || substr(sha256('ambrel:customer:' || c_name), 1, 16))::UBIGINT & 9223372036854775807)::BIGINT AS stable_id FROM customer")
def stable_key(spark, d):
    return table(spark, d, "customer").select("c_custkey", S.stable_id("customer", F.col("c_name")).alias("stable_id"))


@query("""
SELECT rule, count(*) AS n FROM (
  SELECT 'flag' AS rule FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') UNION ALL
  SELECT 'quantity' FROM lineitem WHERE l_quantity NOT BETWEEN 1 AND 45 UNION ALL
  SELECT 'flag_status' FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'F' UNION ALL
  SELECT 'status' FROM orders WHERE o_orderstatus NOT IN ('O', 'F') UNION ALL
  SELECT 'duplicate_line' FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)) GROUP BY rule""")
def contract_issues(spark, d):
    """Every rule broken by a row is an issue of its own; the rules of a table share one pass."""
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    issue = lambda cond, name: F.when(cond, F.lit(name))
    of = lambda df, *rules: df.select(F.explode(F.array_compact(F.array(*rules))).alias("rule"))
    found = of(lines, issue(~F.col("l_returnflag").isin("A", "N"), "flag"), issue(~F.col("l_quantity").between(1, 45), "quantity"), issue((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), "flag_status"))
    found = found.union(of(orders, issue(~F.col("o_orderstatus").isin("O", "F"), "status")))
    twice = lines.groupBy("l_orderkey", "l_linenumber").count().where("count > 1").select(F.lit("duplicate_line").alias("rule"))
    return found.union(twice).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_name, p_brand, p_type, p_size, count(*) AS n, min(p_partkey) AS first_key FROM part GROUP BY ALL HAVING count(*) > 1")
def duplicate_natural_key(spark, d):
    return table(spark, d, "part").groupBy("p_name", "p_brand", "p_type", "p_size").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_key")).where("n > 1")


@query("SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS n_distinct, max(l_linenumber)::BIGINT AS top FROM lineitem GROUP BY 1 HAVING NOT (min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*))")
def line_order_contiguity(spark, d):
    n = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.size(F.collect_set("l_linenumber")).cast("long").alias("n_distinct"), F.max("l_linenumber").cast("long").alias("top"), F.min("l_linenumber").alias("low"))
    return n.where("not (low = 1 and top = n and n_distinct = n)").drop("low")


@query("SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = 1 GROUP BY 1 HAVING count(l_orderkey) <> 1")
def missing_or_dup_primary(spark, d):
    first = table(spark, d, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "orders").select("o_orderkey").join(first, "o_orderkey", "left").select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


@query("""
SELECT 'order' AS kind, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey) UNION ALL
SELECT 'part', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 40) UNION ALL
SELECT 'supplier', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)""")
def broken_references(spark, d):
    lines = table(spark, d, "lineitem")
    cases = [("order", "orders", "l_orderkey", "o_orderkey", "true"), ("part", "part", "l_partkey", "p_partkey", "p_size < 40"), ("supplier", "supplier", "l_suppkey", "s_suppkey", "true")]
    parts = [R.orphans(lines.select(c), table(spark, d, t).where(w), c, p).agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("n")) for k, t, c, p, w in cases]
    return parts[0].union(parts[1]).union(parts[2])


@query("SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def export_missing(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "source").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""
SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(DISTINCT doc_id) FROM labels JOIN documents USING (doc_id)) AS covered,
(SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS missing,
(SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS orphaned""")
def coverage_status(spark, d):
    docs = table(spark, d, "documents").groupBy("doc_id").agg(F.count(F.lit(1)).alias("d"))
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.count(F.lit(1)).alias("l"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    both = docs.join(labels, "doc_id", "full_outer")
    return both.agg(zero("d").alias("total"), F.count_if(F.col("d").isNotNull() & F.col("l").isNotNull()).alias("covered"), zero(F.when(F.col("l").isNull(), F.col("d"))).alias("missing"), zero(F.when(F.col("d").isNull(), F.col("l"))).alias("orphaned"))


@query("""
WITH a AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'), r AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R')
SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM r)) AS left_only, (SELECT count(*) FROM (SELECT * FROM r EXCEPT SELECT * FROM a)) AS right_only,
(SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM r)) AS "both\"""")
def edge_reconcile(spark, d):
    lines = table(spark, d, "lineitem")
    side = lambda f: lines.where(F.col("l_returnflag") == f).select("l_partkey", "l_suppkey")
    return R.set_differences(side("A"), side("R"))


@query("""
SELECT s_suppkey, count(*) AS n, min(c_custkey) AS first_customer FROM supplier JOIN customer
ON nullif(c_nationkey, 0) IS NOT DISTINCT FROM nullif(s_nationkey, 0) AND round(c_acctbal / 1000) = round(s_acctbal / 1000) GROUP BY 1""")
def null_safe_match(spark, d):
    """Both sides are counted by key before they meet, so no pair of rows is made; a null key is a key."""
    side = lambda t, p: table(spark, d, t).withColumns({f"{p}_n": F.expr(f"nullif({p}_nationkey, 0)"), f"{p}_b": F.expr(f"round({p}_acctbal / 1000)")})
    customers = side("customer", "c").groupBy("c_n", "c_b").agg(F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("first_customer"))
    matched = side("supplier", "s").join(customers, F.expr("c_n <=> s_n and c_b = s_b"))
    return matched.groupBy("s_suppkey").agg(F.sum("n").alias("n"), F.min("first_customer").alias("first_customer"))


@query("""
WITH refs AS (SELECT DISTINCT p_name AS ref FROM part UNION SELECT 'no such part' UNION SELECT DISTINCT p_type FROM part),
hits AS (SELECT ref, p_partkey FROM refs JOIN part ON p_name = ref UNION SELECT ref, p_partkey FROM refs JOIN part ON p_type = ref)
SELECT ref, count(p_partkey) AS matches, CASE count(p_partkey) WHEN 0 THEN 'none' WHEN 1 THEN 'one' ELSE 'many' END AS verdict FROM refs LEFT JOIN hits USING (ref) GROUP BY ref""")
def exactly_one_match(spark, d):
    part = table(spark, d, "part")
    refs = part.select(F.col("p_name").alias("ref")).union(part.select("p_type")).union(spark.sql("select 'no such part'")).distinct()
    return R.match_counts(refs, part, "ref", ["p_name", "p_type"], "p_partkey")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1")
def latest_event(spark, d):
    return R.latest(table(spark, d, "events"), ["user_id", "event_type"], [F.desc_nulls_last("ts"), F.desc_nulls_last("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id, " + ", ".join(f"coalesce(max(value) FILTER (event_type = '{t}'), 0.5) AS {t}" for t in TRAITS) + " FROM events GROUP BY user_id")
def trait_pivot(spark, d):
    return R.pivot_max(table(spark, d, "events"), "user_id", "event_type", "value", TRAITS, 0.5)


@query("""
SELECT o_custkey, o_orderkey, (coalesce(top, 0) + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey))::BIGINT AS ordinal
FROM (SELECT * FROM orders WHERE o_orderkey % 10 = 0) n LEFT JOIN (SELECT o_custkey, count(*) AS top FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY 1) USING (o_custkey)""")
def next_ordinal(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    old = orders.where("o_orderkey % 10 <> 0").withColumn("ordinal", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")))
    return R.append_ordinals(old, orders.where("o_orderkey % 10 = 0"), "o_custkey", "ordinal", [F.col("o_orderkey")])


@query("""
SELECT lang, count(*) AS n, count(DISTINCT source) AS sources, sum(n_chars)::BIGINT AS chars, round(count(*) FILTER (n_chars >= 1000) / count(*), 4) AS long_share,
count(*) FILTER (text IS NULL OR text = '') AS empty FROM documents GROUP BY lang""")
def dataset_profile(spark, d):
    n = F.count(F.lit(1))
    return table(spark, d, "documents").groupBy("lang").agg(n.alias("n"), F.size(F.collect_set("source")).cast("long").alias("sources"), F.sum("n_chars").alias("chars"), F.round(F.count_if(F.col("n_chars") >= 1000) / n, 4).alias("long_share"), F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("empty"))


RULES = [(["the ", " and "], "common", 0.4), (["License", "licensed"], "legal", 0.9), (["token", "@"], "private", 0.8), (["###", "$$$"], "common", 0.1)]


@query("SELECT doc_id, " + ", ".join("CASE " + " ".join("WHEN " + " OR ".join(f"contains(text, '{t}')" for t in ts) + f" THEN {v}::DOUBLE" for ts, k, v in reversed(RULES) if k == dim) + f" END AS {dim}" for dim in ("common", "legal", "private")) + " FROM documents")
def keyword_rules(spark, d):
    return K.keyword_scores(table(spark, d, "documents"), F.col("text"), RULES).select("doc_id", "common", "legal", "private")


@query("""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.!?]'), lambda x: trim(x)), lambda x: length(x) >= 10) AS facts FROM documents)
SELECT doc_id, len(facts)::BIGINT AS facts, CASE WHEN len(facts) = 0 THEN 0.35::DOUBLE ELSE round(least(0.9::DOUBLE, 0.48::DOUBLE + list_sum(list_transform(facts[1:8], lambda x: least(length(x), 120))) / 900::DOUBLE), 2) END AS confidence FROM s""")
def fact_confidence(spark, d):
    facts = S.sentences(F.coalesce("text", F.lit("")))
    docs = table(spark, d, "documents").select("doc_id", facts.alias("facts"))
    return docs.select("doc_id", F.size("facts").cast("long").alias("facts"), K.confidence(F.transform(F.slice("facts", 1, 8), lambda f: F.length(f))).alias("confidence"))


@query("""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[.!?]'), lambda x: trim(x)), lambda x: length(x) >= 10) AS facts FROM documents),
e AS (SELECT doc_id, unnest(facts) AS fact, unnest(range(len(facts))) AS i FROM s)
SELECT doc_id, i::BIGINT AS fact FROM e QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY contains(fact, 'the')::INT + contains(fact, 'ion')::INT DESC, least(length(fact), 80) DESC, i) = 1""")
def best_evidence(spark, d):
    facts = S.sentences(F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").select("doc_id", K.best_evidence(facts, ["the", "ion"]).cast("long").alias("fact")).where("fact is not null")


@query("SELECT doc_id, round(0.1 + 0.8 / (1 + exp(-(n_chars - (SELECT avg(n_chars) FROM documents)) / (1.15 * greatest((SELECT stddev_pop(n_chars) FROM documents), 0.025)))), 4) AS score FROM documents")
def calibrated_score(spark, d):
    return E.calibrated(table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars").select("doc_id", "score")


@query("""
WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS m FROM x GROUP BY 1, 2)
SELECT vec_id, round(greatest(0, least(1, 1 - sum(abs(v - m)) / count(*))), 4) AS similarity FROM x JOIN c USING (label, i) GROUP BY vec_id""")
def l1_similarity(spark, d):
    vectors = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    means = vectors.select("label", F.posexplode("v")).groupBy("label", "pos").agg(F.avg("col").alias("m"))
    centre = means.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("c"))
    return vectors.join(centre, "label").select("vec_id", F.round(S.l1_similarity(F.col("v"), F.col("c")), 4).alias("similarity"))


@query("""
WITH r AS (SELECT lang, n_chars, quality FROM documents JOIN labels USING (doc_id)),
s AS (SELECT lang, n_chars, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality <> 1) AS neg FROM r GROUP BY 1, 2),
b AS (SELECT *, sum(neg) OVER (PARTITION BY lang ORDER BY n_chars) - neg / 2 AS below FROM s)
SELECT lang, (sum(pos) * sum(neg))::BIGINT AS pairs, sum(pos * below)::DOUBLE AS wins, round(sum(pos * below) / (sum(pos) * sum(neg)), 6) AS auc FROM b GROUP BY lang HAVING sum(pos) * sum(neg) > 0""")
def within_group_auc(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(table(spark, d, "labels"), "doc_id")
    return E.group_auc(rows, "lang", "n_chars", F.col("quality") == 1)


@query(" UNION ALL ".join(f"SELECT '{k}' AS variant, round(avg(s) FILTER (quality = 1), 6) AS positive, round(avg(s) FILTER (quality <> 1), 6) AS negative, count(*) AS n FROM (SELECT quality, {e} AS s FROM documents JOIN labels USING (doc_id))" for k, e in (("length", "least(n_chars / 5000, 1)"), ("language", "CASE WHEN lang = 'en' THEN 1.0 ELSE 0.5 END"), ("blend", "0.7 * least(n_chars / 5000, 1) + 0.3 * CASE WHEN lang = 'en' THEN 1.0 ELSE 0.5 END"))))
def ablation_variants(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(table(spark, d, "labels"), "doc_id")
    length, language = F.least(F.col("n_chars") / 5000, F.lit(1.0)), F.when(F.col("lang") == "en", 1.0).otherwise(0.5)
    long = E.long_variants(rows, ["quality"], {"length": length, "language": language, "blend": 0.7 * length + 0.3 * language})
    mean = lambda c: F.round(F.avg(F.when(c, F.col("score"))), 6)
    return long.groupBy("variant").agg(mean(F.col("quality") == 1).alias("positive"), mean(F.col("quality") != 1).alias("negative"), F.count(F.lit(1)).alias("n"))


_CHANGES = "SELECT o_orderkey, o_custkey, 'P' AS o_orderstatus, NULL::DOUBLE AS o_totalprice FROM orders WHERE o_orderkey % 10 = 0 UNION ALL SELECT o_orderkey + 100000000, o_custkey, 'N', 1.0 FROM orders WHERE o_orderkey % 100 = 0"


def _change(spark, d):
    old = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    some = old.where("o_orderkey % 10 = 0").withColumns({"o_orderstatus": F.lit("P"), "o_totalprice": F.lit(None).cast("double")})
    more = old.where("o_orderkey % 100 = 0").withColumns({"o_orderkey": F.col("o_orderkey") + 100000000, "o_orderstatus": F.lit("N"), "o_totalprice": F.lit(1.0)})
    return old, some.union(more)


@query(f"""
WITH n AS ({_CHANGES})
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, coalesce(o.o_custkey, n.o_custkey) AS o_custkey,
CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_totalprice ELSE o.o_totalprice END AS o_totalprice FROM orders o FULL JOIN n ON o.o_orderkey = n.o_orderkey""")
def enrich_overlay(spark, d):
    old, new = _change(spark, d)
    return R.upsert(old, new, "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("SELECT 0::BIGINT AS left_only, 0::BIGINT AS right_only, count(*) AS \"both\" FROM (SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders)")
def rollback_identity(spark, d):
    old, new = _change(spark, d)
    before = old.join(new.select("o_orderkey"), "o_orderkey", "left_semi")
    return R.set_differences(R.restore(R.upsert(old, new, "o_orderkey", old.columns), new, before, "o_orderkey"), old)


@query("SELECT event_id, user_id, event_type, row_number() OVER w AS version, (row_number() OVER w = count(*) OVER (PARTITION BY user_id, event_type))::INTEGER AS is_current FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts NULLS FIRST, event_id NULLS FIRST)")
def scd2_versions(spark, d):
    out = R.versions(table(spark, d, "events"), ["user_id", "event_type"], [F.asc_nulls_first("ts"), F.asc_nulls_first("event_id")])
    return out.select("event_id", "user_id", "event_type", F.col("version").cast("long").alias("version"), "is_current")


@query("""
SELECT user_id, t.event_type, round(avg(value), 6) AS score, CASE WHEN count(value) = 0 THEN 4 ELSE 1 END AS state
FROM (SELECT DISTINCT user_id FROM events) CROSS JOIN (SELECT DISTINCT event_type FROM events) t LEFT JOIN events e USING (user_id, event_type) GROUP BY ALL""")
def sparse_catalog(spark, d):
    """The catalogue, one list of the types there are, is exploded beside each user. A null type is none."""
    events = table(spark, d, "events")
    means = events.groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("score"))
    users = means.groupBy("user_id").agg(F.map_from_entries(F.filter(F.collect_list(F.struct("event_type", "score")), lambda e: e["event_type"].isNotNull())).alias("m"))
    kinds = events.agg(F.sort_array(F.collect_set("event_type"))).scalar()
    return users.select("user_id", "m", F.explode(kinds).alias("event_type")).select("user_id", "event_type", F.try_element_at("m", "event_type").alias("score")).withColumn("state", F.when(F.col("score").isNull(), 4).otherwise(1))


@query("SELECT vec_id, i - 1 AS position, (i - 1 + vec_id) % len(embedding) AS asked, embedding[(i - 1 + vec_id) % len(embedding) + 1]::DOUBLE AS v FROM (SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings)")
def positional_join(spark, d):
    """Every position of a vector asks for the item as many places on as the vector's number, round the end."""
    vectors = table(spark, d, "embeddings")
    items = vectors.select("vec_id", F.posexplode("embedding").alias("at", "v")).select("vec_id", F.col("at").cast("long").alias("asked"), F.col("v").cast("double").alias("v"))
    n = F.size("embedding").cast("long")
    wanted = vectors.select("vec_id", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("position")).withColumn("asked", (F.col("position") + F.col("vec_id")) % F.col("n"))
    return wanted.join(items, ["vec_id", "asked"]).select("vec_id", "position", "asked", "v")


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, (props->'$.k') IS NOT NULL AS has_k FROM events")
def json_props(spark, d):
    v = F.try_parse_json("props")
    return table(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.variant_get(v, "$.k", "variant").isNotNull().alias("has_k"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_repair(spark, d):
    """Fences and trailing commas are put in and taken out again."""
    broken = F.concat(F.lit("```json\n"), F.regexp_replace("props", r"\}$", ",}"), F.lit("\n```"))
    return table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json(S.repair_json(broken)), "$.k", "bigint").alias("k"))


@query("SELECT regexp_replace(lower(p_name), '\\s+\\S+$', '') AS base, count(*) AS n, count(DISTINCT p_name) AS spellings FROM part GROUP BY 1 HAVING count(DISTINCT p_name) > 1")
def prefix_dedup(spark, d):
    base = F.regexp_replace(F.lower("p_name"), r"\s+\S+$", "")
    return table(spark, d, "part").groupBy(base.alias("base")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_name").alias("spellings")).where("spellings > 1")


@query("WITH n AS (SELECT DISTINCT lower(x) AS name FROM (SELECT p_name AS x FROM part UNION SELECT p_type FROM part UNION SELECT p_brand FROM part UNION SELECT split_part(p_name, ' ', 1) FROM part)) SELECT a.name AS short, b.name AS long FROM n a JOIN n b ON a.name <> b.name AND contains(b.name, a.name) AND length(a.name) >= 2")
def subset_pairs(spark, d):
    """Containment by an equality join on the shorter name's rarest bigram, then the exact test."""
    part = table(spark, d, "part")
    names = part.select(F.explode(F.array("p_name", "p_type", "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)))).alias("x")).select(F.lower("x").alias("name")).distinct().where(F.length("name") >= 2)
    grams = names.select("name", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("name") - 1), lambda i: F.substring("name", i, F.lit(2))))).alias("g"))
    rare = grams.join(grams.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "g").groupBy("name").agg(F.min(F.struct("n", "g"))["g"].alias("g"))
    pairs = rare.select(F.col("name").alias("short"), "g").join(grams.select(F.col("name").alias("long"), "g"), "g")
    return pairs.where((F.col("short") != F.col("long")) & F.contains("long", "short")).select("short", "long")


@query("""
WITH RECURSIVE e AS (SELECT 'nation:' || n_nationkey AS s, 'region:' || n_regionkey AS t FROM nation UNION SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer),
c AS (SELECT s, t FROM e UNION SELECT c.s, e.t FROM c JOIN e ON c.t = e.s) SELECT s, t FROM c""")
def closure(spark, d):
    name = lambda kind, c: F.concat(F.lit(kind + ":"), F.col(c).cast("string"))
    edges = table(spark, d, "nation").select(name("nation", "n_nationkey").alias("s"), name("region", "n_regionkey").alias("t"))
    edges = edges.union(table(spark, d, "customer").select(name("customer", "c_custkey"), name("nation", "c_nationkey")))
    return R.transitive_closure(edges, "s", "t", keeper(spark))


@query("WITH f AS (SELECT user_id, event_type, min(r) AS p FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS r FROM events) GROUP BY 1, 2) SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY p) - 1 AS ordinal FROM f")
def ordered_distinct(spark, d):
    return R.ordered_distinct(table(spark, d, "events"), "user_id", "event_type", [F.asc_nulls_first("ts"), F.asc_nulls_first("event_id")])


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 1000 + 950 <= 999 THEN 'supplier_' || lpad((s_suppkey % 1000 + 950)::VARCHAR, 3, '0') END AS shifted, CASE WHEN s_suppkey % 1000 + 950 > 999 THEN 'pending' ELSE 'resolved' END AS state FROM supplier")
def namespace_shift(spark, d):
    code = F.concat(F.lit("supplier_"), F.lpad((F.col("s_suppkey") % 1000).cast("string"), 3, "0"))
    shifted = S.shift_suffix(code, 950)
    return table(spark, d, "supplier").select("s_suppkey", shifted.alias("shifted"), F.when(shifted.isNull(), "pending").otherwise("resolved").alias("state"))


@query("SELECT o_orderkey, coalesce(string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey), '') AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def nest_children(spark, d):
    item = F.concat_ws(":", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    out = R.nest(table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem"), "o_orderkey", "l_orderkey", item, F.struct("l_linenumber", "l_partkey", "l_suppkey"), "lines")
    return out.select("o_orderkey", F.array_join("lines", ",").alias("lines"))


@query("""
WITH n AS (SELECT c_nationkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer)
SELECT c_nationkey, i // 10 AS batch, count(*) AS n, string_agg((i % 10 + 1) || '. ' || c_name, chr(10) ORDER BY i) AS prompt FROM n GROUP BY 1, 2""")
def chunk_batches(spark, d):
    i = F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    rows = table(spark, d, "customer").select("c_nationkey", "c_name", i.alias("i")).withColumn("batch", F.floor(F.col("i") / 10))
    names = F.sort_array(F.collect_list(F.struct("i", "c_name")))
    lines = F.array_join(F.transform(names, lambda x, k: F.concat((k + 1).cast("string"), F.lit(". "), x["c_name"])), "\n")
    return rows.groupBy("c_nationkey", "batch").agg(F.count(F.lit(1)).alias("n"), lines.alias("prompt"))


@query("SELECT source, count(*) FILTER (l.doc_id IS NOT NULL) AS processed, count(*) FILTER (l.doc_id IS NULL) AS remaining, min(d.doc_id) FILTER (l.doc_id IS NULL) AS next_id FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY source")
def resume_remaining(spark, d):
    done = table(spark, d, "labels").select("doc_id").distinct().withColumn("done", F.lit(True))
    rows = table(spark, d, "documents").select("doc_id", "source").join(done, "doc_id", "left")
    left = F.col("done").isNull()
    return rows.groupBy("source").agg(F.count_if(~left).alias("processed"), F.count_if(left).alias("remaining"), F.min(F.when(left, F.col("doc_id"))).alias("next_id"))


@query("""
WITH t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, turn, 'question: ' || text || chr(10) || 'answer: ' || answer AS example FROM t WHERE role = 'user' AND next_role = 'assistant' AND text <> '' AND answer <> ''""")
def training_examples(spark, d):
    w = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = table(spark, d, "conversations").withColumns({"next_role": F.lead("role").over(w), "answer": F.lead("text").over(w)})
    rows = rows.where("role = 'user' and next_role = 'assistant' and text <> '' and answer <> ''")
    return rows.select("conv_id", "turn", S.labelled_lines([("question", F.col("text")), ("answer", F.col("answer"))]).alias("example"))


@query("SELECT doc_id, CASE WHEN ('0x' || substr(sha256('split-7:' || doc_id), 1, 8))::UBIGINT / 4294967295.0 < 0.1 THEN 'eval' ELSE 'train' END AS part FROM documents")
def seeded_split(spark, d):
    return table(spark, d, "documents").select("doc_id", F.when(S.hash_unit("split-7:", F.col("doc_id")) < 0.1, "eval").otherwise("train").alias("part"))


@query("SELECT round(avg(pow(least(n_chars / 5000, 1) - quality, 2)), 6) AS mse, round(avg(abs(least(n_chars / 5000, 1) - quality)), 6) AS mae, count(*) AS n FROM documents JOIN labels USING (doc_id)")
def regression_metrics(spark, d):
    e = F.least(F.col("n_chars") / 5000, F.lit(1.0)) - F.col("quality")
    rows = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id")
    return rows.agg(F.round(F.avg(e * e), 6).alias("mse"), F.round(F.avg(F.abs(e)), 6).alias("mae"), F.count(F.lit(1)).alias("n"))


_AUDIT = "SELECT count(*) FILTER (n_chars IS NULL) AS no_length, count(*) FILTER (n_chars <> length(text)) AS wrong_length, count(*) FILTER (lang NOT IN ('de', 'en', 'es', 'fr')) AS wrong_lang, min(n_chars) AS shortest, max(n_chars) AS longest FROM documents"


def _audit(spark, d):
    return table(spark, d, "documents").agg(F.count_if(F.col("n_chars").isNull()).alias("no_length"), F.count_if(F.col("n_chars") != F.length("text")).alias("wrong_length"), F.count_if(~F.col("lang").isin("de", "en", "es", "fr")).alias("wrong_lang"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"))


@query(_AUDIT)
def audit_checks(spark, d):
    return _audit(spark, d)


@query(f"SELECT bool_and(v = 0) AS accepted, count(*) FILTER (v <> 0) AS failed FROM (SELECT unnest([no_length, wrong_length, wrong_lang]) AS v FROM ({_AUDIT}))")
def acceptance(spark, d):
    checks = _audit(spark, d).select(F.explode(F.array("no_length", "wrong_length", "wrong_lang")).alias("v"))
    return checks.agg(F.bool_and(F.col("v") == 0).alias("accepted"), F.count_if(F.col("v") != 0).alias("failed"))


@query("SELECT string_agg('(' || (i - 1) || ', ''' || event_type || ''')', ',' ORDER BY i) AS seed FROM (SELECT event_type, row_number() OVER (ORDER BY event_type) AS i FROM (SELECT DISTINCT event_type FROM events))")
def seed_sql(spark, d):
    kinds = table(spark, d, "events").select("event_type").distinct().agg(F.sort_array(F.collect_list("event_type")).alias("k"))
    row = lambda k, i: F.concat(F.lit("("), i.cast("string"), F.lit(", "), S.sql_quote(k), F.lit(")"))
    return kinds.select(F.array_join(F.transform("k", row), ",").alias("seed"))


PHRASES = "(licensed under|released under|token =|lorem ipsum|as an ai)"


@query(f"SELECT doc_id, regexp_extract(lower(text), '{PHRASES}') AS phrase FROM documents WHERE regexp_matches(lower(text), '{PHRASES}')")
def forbidden_phrases(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("t")).where(F.col("t").rlike(PHRASES))
    return docs.select("doc_id", F.regexp_extract("t", PHRASES, 0).alias("phrase"))


@query("SELECT r_name, s.c_mktsegment AS segment, count(c_custkey) AS n FROM region CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer) s LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer c ON c_nationkey = n_nationkey AND c.c_mktsegment = s.c_mktsegment GROUP BY 1, 2")
def scaffold_grid(spark, d):
    """The grid of regions and segments, filled with what there is."""
    customers, nations, regions = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    counts = customers.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n")).join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "c_mktsegment").agg(F.sum("n").alias("n"))
    segments = customers.select(F.col("c_mktsegment").alias("segment")).distinct()
    grid = segments.crossJoin(F.broadcast(regions.select("r_regionkey", "r_name")))
    return grid.join(counts, (F.col("r_regionkey") == F.col("n_regionkey")) & (F.col("segment") == F.col("c_mktsegment")), "left").select("r_name", "segment", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, NULL::VARCHAR AS error FROM events")
def model_json_repair(spark, d):
    """Properties as a careless model would write them: fenced, with a trailing comma, the last brace lost."""
    broken = F.concat(F.lit("```json\n"), F.regexp_replace("props", r"\}$", ","), F.lit("\n```"))
    found = table(spark, d, "events").select("event_id", X.repaired_json(F.regexp_replace(broken, r",\n", "\n")).alias("j"))
    return found.select("event_id", F.try_variant_get(F.try_parse_json("j.value"), "$.k", "bigint").alias("k"), "j.error")


@query("SELECT user_id, (floor((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) / 5))::BIGINT AS batch, event_id FROM events")
def partial_arrays(spark, d):
    """Arrays of five events that break off within a sixth object give all five."""
    rows = table(spark, d, "events").select("user_id", "event_id", F.row_number().over(W.partitionBy("user_id").orderBy("event_id")).alias("r")).withColumn("batch", F.floor((F.col("r") - 1) / 5))
    texts = rows.groupBy("user_id", "batch").agg(F.concat(F.lit("[ "), F.array_join(F.transform(F.sort_array(F.collect_list("event_id")), lambda e: F.format_string('{"event": %d, "note": "a ] } b"}', e)), ", "), F.lit(', {"event": 1')).alias("t"))
    items = texts.select("user_id", "batch", F.explode(X.complete_objects("t")).alias("o"))
    return items.select("user_id", "batch", F.try_variant_get(F.try_parse_json("o"), "$.event", "bigint").alias("event_id"))


@query("SELECT p_partkey, regexp_extract_all(p_name || ' \"' || p_type || '\", \"' || p_brand || '\"', '\"([^\"]+)\"', 1)[2] AS second FROM part")
def quoted_names(spark, d):
    text = F.concat("p_name", F.lit(' "'), "p_type", F.lit('", "'), "p_brand", F.lit('"'))
    return table(spark, d, "part").select("p_partkey", F.try_element_at(X.quoted_names(text), F.lit(2)).alias("second"))


@query("SELECT doc_id, coalesce(b.kind, a.kind) AS kind FROM (SELECT doc_id, 'document' AS kind FROM documents) a FULL JOIN (SELECT DISTINCT doc_id, 'label' AS kind FROM labels) b USING (doc_id)")
def merged_by_priority(spark, d):
    """Labels come before documents; of each id the first row of the first source stays."""
    side = lambda t, k: table(spark, d, t).select("doc_id", F.lit(k).alias("kind"), F.lit(0).alias("position"))
    return X.by_priority([side("labels", "label"), side("documents", "document")], "doc_id", "position").select("doc_id", "kind")


@query("""
WITH RECURSIVE n AS (SELECT DISTINCT x AS name, lower(x) AS low FROM (SELECT p_name AS x FROM part UNION SELECT upper(p_name) FROM part)),
e AS (SELECT a.name AS a, b.name AS b FROM n a JOIN n b ON a.name <> b.name AND (a.low = b.low OR (length(a.low) >= 2 AND contains(b.low, a.low)) OR (length(b.low) >= 2 AND contains(a.low, b.low)))),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a AS p_name, least(a, min(b)) AS component FROM r GROUP BY a""")
def name_groups(spark, d):
    """Parts' names in groups, by case and by containment, merged into components."""
    part = table(spark, d, "part")
    return N.name_groups(part.select("p_name").union(part.select(F.upper("p_name"))), "p_name", keeper(spark))


@query("""
WITH RECURSIVE t AS (SELECT c_custkey AS c, 'n' || c_nationkey || ':' || floor(c_acctbal / 20)::BIGINT AS k FROM customer UNION SELECT c_custkey, c_mktsegment || ':' || floor(c_acctbal / 3)::BIGINT FROM customer),
m AS (SELECT k, min(c) AS a FROM t GROUP BY k), e AS (SELECT DISTINCT a, c AS b FROM t JOIN m USING (k) WHERE a <> c), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a) SELECT a AS c_custkey, least(a, min(b)) AS component FROM r GROUP BY a""")
def duplicate_components(spark, d):
    """Customers that share a token (nation or segment with a band of the balance), merged into components."""
    band = lambda w: F.floor(F.col("c_acctbal") / w).cast("string")
    tokens = F.array(F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit(":"), band(20)), F.concat("c_mktsegment", F.lit(":"), band(3)))
    rows = table(spark, d, "customer").select("c_custkey", F.explode(tokens).alias("token"))
    return N.components(N.linked_by(rows, "c_custkey", F.col("token"), "token").select("a", "b"), keeper(spark)).withColumnRenamed("node", "c_custkey")


@query("SELECT lower(p_name) AS low, count(DISTINCT x) AS spellings FROM (SELECT p_name, p_name AS x FROM part UNION SELECT p_name, upper(p_name) FROM part) GROUP BY 1 HAVING count(DISTINCT x) > 1")
def case_groups(spark, d):
    part = table(spark, d, "part")
    both = part.select("p_name").union(part.select(F.upper("p_name")))
    links = N.linked_by(both, "p_name", F.lower("p_name"), "case")
    return links.groupBy(F.lower("a").alias("low")).agg((F.count(F.lit(1)) + 1).alias("spellings"))


@query("SELECT 'rolled_back' AS status, 0::BIGINT AS missing_before, (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 0)::BIGINT AS missing_after, 0::BIGINT AS left_only, 0::BIGINT AS right_only")
def run_rollback(spark, d):
    """A run of changes is loaded and rolled back: the table is as before, and what the run had added is missing."""
    old, new = _change(spark, d)
    store = G.Store(spark, new_place(spark, "runs"))
    store.write("orders", old)
    run = store.load("orders", {"orders": ("o_orderkey", old.columns, new)})["run"]
    loaded = store.status(run).select(F.col("missing").alias("missing_before"))
    loaded = spark.createDataFrame(loaded.collect(), loaded.schema)  # one row; the table changes below
    status = store.rollback(run)["status"]
    after = store.status(run).select(F.lit(status).alias("status"), F.col("missing").alias("missing_after"))
    same = R.set_differences(store.read("orders"), old).select("left_only", "right_only")
    one = F.lit(1).alias("one")
    rows = [x.select(one, "*") for x in (after, loaded, same)]
    return rows[0].join(rows[1], "one").join(rows[2], "one").drop("one")


@query("SELECT DISTINCT event_id, event_type FROM events")
def stream_distinct_events(spark, d):
    """The events as a stream, each once, appended to files and read back."""
    home = new_place(spark, "stream")
    schema = table(spark, d, "events").schema
    stream = V.files(spark, f"{d}/events*.parquet", schema)
    V.append_available(V.distinct(stream.select("event_id", "event_type"), ["event_id", "event_type"]), f"{home}/out", f"{home}/checkpoint")
    return spark.read.schema("event_id long, event_type string").parquet(f"{home}/out")


_AT_BEST = lambda f, by: f"SELECT {by}, avg(value) AS mean, [" + ", ".join(f"coalesce({f}(value) FILTER (event_type = '{t}') / any_value(m), 0.5)" for t in TRAITS) + f"] AS v FROM e, top GROUP BY {by}"


@query(f"""
WITH e AS (SELECT *, (props->>'$.k')::BIGINT AS object, CASE WHEN event_type IN ('purchase', 'click') THEN 1 WHEN event_type = 'error' THEN -1 END AS rating FROM events),
top AS (SELECT coalesce(nullif(max(value), 0), 1) AS m FROM events),
rated AS (SELECT user_id, object, rating FROM e WHERE rating IS NOT NULL AND object IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id, object ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1),
users AS ({_AT_BEST("avg", "user_id")}), objects AS ({_AT_BEST("max", "object")}),
s AS (SELECT user_id, rating, greatest(0, least(1, 1 - list_sum(list_transform(range(1, {len(TRAITS) + 1}), lambda i: abs(u.v[i] - o.v[i]))) / {len(TRAITS)})) AS likeness, greatest(0, least(1, o.mean / m)) AS popular
  FROM rated JOIN users u USING (user_id) JOIN objects o USING (object), top),
long AS (SELECT 'base' AS variant, user_id, rating, round(popular, 9) AS score FROM s UNION ALL SELECT 'similar', user_id, rating, round(likeness, 9) FROM s UNION ALL SELECT 'blend', user_id, rating, round(0.7::DOUBLE * likeness + 0.3::DOUBLE * popular, 9) FROM s),
n AS (SELECT variant, user_id, score, count(*) FILTER (rating > 0) AS pos, count(*) FILTER (rating <= 0) AS neg FROM long GROUP BY ALL),
b AS (SELECT *, sum(neg) OVER (PARTITION BY variant, user_id ORDER BY score) - neg / 2 AS below FROM n),
g AS (SELECT variant, user_id, sum(pos) * sum(neg) AS pairs, sum(pos * below) AS wins FROM b GROUP BY ALL HAVING sum(pos) * sum(neg) > 0)
SELECT variant, sum(pairs)::BIGINT AS pairs, sum(wins)::DOUBLE AS wins, round(sum(wins) / sum(pairs), 6) AS auc FROM g GROUP BY variant""")
def recommendation_prior(spark, d):
    """The flagship: latest ratings, user and object vectors, similarity, ablations and within-user AUC.

    The greatest value is a scalar subquery: no action runs while the plan is made. Objects are read from the properties
    once for each use, in the scan; ratings and both vectors meet by equality joins.
    """
    raw = table(spark, d, "events")
    events = raw.withColumn("object", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint"))
    rating = F.when(F.col("event_type").isin("purchase", "click"), 1).when(F.col("event_type") == "error", -1)
    last = F.max_by(F.col("rating"), F.struct(F.col("ts"), F.col("event_id")))
    rated = events.withColumn("rating", rating).where("rating is not null and object is not null").groupBy("user_id", "object").agg(last.alias("rating"))
    top = F.coalesce(F.nullif(raw.agg(F.max("value")).scalar(), F.lit(0.0)), F.lit(1.0))
    vector = lambda f: F.array(*[f(F.when(F.col("event_type") == t, F.col("value"))) for t in TRAITS])
    scaled = lambda c: F.transform(c, lambda x: F.coalesce(x / F.col("top"), F.lit(0.5)))
    users = raw.groupBy("user_id").agg(vector(F.avg).alias("u"))
    objects = events.where("object is not null").groupBy("object").agg(vector(F.max).alias("o"), F.avg("value").alias("mean"))
    rows = rated.join(users, "user_id").join(objects, "object").withColumn("top", top)
    similar, popular = S.l1_similarity(scaled("u"), scaled("o")), S.clamp(F.col("mean") / F.col("top"))
    rows = rows.select("user_id", "rating", similar.alias("s"), popular.alias("p"))
    long = E.long_variants(rows, ["user_id", "rating"], {"base": F.col("p"), "similar": F.col("s"), "blend": 0.7 * F.col("s") + 0.3 * F.col("p")})
    auc = E.group_auc(long.withColumn("score", F.round("score", 9)), ["variant", "user_id"], "score", F.col("rating") > 0)
    return auc.groupBy("variant").agg(F.sum("pairs").alias("pairs"), F.sum("wins").alias("wins"), F.round(F.sum("wins") / F.sum("pairs"), 6).alias("auc"))
