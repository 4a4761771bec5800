"""Projections, priors, resumable work and synchronisation over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import evaluation as E
from ..operators import projection as P
from ..operators import resume as U
from ..operators import sync as Y
from ..operators import training as T
from ..sources.scratch import keeper
from ..sources.tables import table
from .catalogue import query


@query("""
WITH words AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM benchmark), w AS (SELECT word FROM words WHERE word <> ''),
hits AS (SELECT doc_id, count(*) FILTER (length(word) % 3 = 0) AS a, count(*) FILTER (length(word) % 3 = 1) AS b, count(*) FILTER (length(word) % 3 = 2) AS g FROM documents JOIN w ON contains(text, word) GROUP BY doc_id),
x AS (SELECT doc_id, lang, least(1, n_chars / 20000) AS size, doc_id % 97 / 97 AS rank, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(g, 0) AS g FROM documents LEFT JOIN hits USING (doc_id)),
r AS (SELECT doc_id AS id, 'A' AS trait, 0.48::DOUBLE * ((size + (1 - rank)) / 2) + 0.52::DOUBLE * least(1::DOUBLE, a / 40) + least(0.2::DOUBLE, g * 0.005::DOUBLE) + CASE WHEN lang = 'en' THEN 0.03::DOUBLE ELSE 0 END AS raw FROM x UNION ALL
SELECT doc_id, 'B', 0.48::DOUBLE * rank + 0.52::DOUBLE * least(1::DOUBLE, b / 40) - least(0.15::DOUBLE, g * 0.003::DOUBLE) + CASE WHEN lang = 'de' THEN 0.05::DOUBLE ELSE 0 END FROM x UNION ALL SELECT doc_id, 'C', 1 - size FROM x UNION ALL SELECT doc_id, 'D', 0.5::DOUBLE FROM x),
s AS (SELECT trait, avg(raw) AS mean, greatest(stddev_pop(raw), 0.025) AS sd FROM r GROUP BY trait)
SELECT id, trait, round(raw, 6) AS raw, round(0.1 + 0.8 / (1 + exp(-(raw - mean) / (sd * 1.15))), 2) AS score FROM r JOIN s USING (trait)""")
def trait_projection(spark, d):
    """Documents projected onto four traits by their sizes and by every word of the benchmark, all looked for at once."""
    docs, c = table(spark, d, "documents"), F.col
    words = table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("word")).where("word <> ''").distinct()
    size = words.agg(F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()[0]
    if size > P.TERM_BYTES:
        raise ValueError("the benchmark's words are too many for a model")
    by = [[], [], []]
    for r in words.collect():  # at most TERM_BYTES
        by[len(r["word"]) % 3].append(r["word"])
    model = P.Model({"A": ["size", "-rank"], "B": ["rank", "void"], "C": ["-size"], "D": ["void"]}, {"A": by[0], "B": by[1]}, [("A", by[2], 0.005, 0.2), ("B", by[2], -0.003, 0.15)], {"en": {"A": 0.03}, "de": {"B": 0.05}}, enough=40)
    values = F.array(*[F.struct(F.lit(p).alias("path"), v.cast("double").alias("value")) for p, v in (("size", F.least(F.lit(1.0), c("n_chars") / 20000)), ("rank", c("doc_id") % 97 / 97), ("void", F.lit(None)), ("other", F.lit(0.9)))])
    leaves = docs.select(c("doc_id").alias("id"), F.explode(values).alias("x")).select("id", "x.*")
    raw = P.raw_traits(docs.select(c("doc_id").alias("id"), c("lang").alias("kind"), "text"), leaves, model)
    return P.calibrated_traits(raw).select("id", "trait", F.round("raw", 6).alias("raw"), "score")


_SAYS = {"click": "INTJ", "purchase": "ESFP", "error": "IXFJ", "signup": "EE", "view": ""}
_ATTITUDE = {"click": 1, "purchase": 2, "error": -1, "signup": 1, "view": 0}
_KINDS = ["INTJ", "ESFP", "ENFJ"]


def _first(kind):
    """Sums of the letters' leads, and how many lead, as SQL."""
    opposite = {a: b for i in range(0, 8, 2) for a, b in (E.LETTERS[i : i + 2], E.LETTERS[i : i + 2][::-1])}
    leads = [f"(w_{x} - w_{opposite[x]})" for x in kind]
    return f"({' + '.join(leads)})", f"({' + '.join(f'({x} > 0)::INT' for x in leads)})"


@query("WITH e AS (SELECT (props->>'$.k')::BIGINT AS object, event_type, greatest(0, coalesce(floor(value)::INT, 0)) AS n FROM events),"
       "s AS (SELECT object, sum(n)::DOUBLE AS evidence, " + ", ".join(f"sum(n * CASE {' '.join(f'WHEN event_type = {chr(39)}{k}{chr(39)} THEN {_ATTITUDE[k] * v.count(x)}' for k, v in _SAYS.items())} ELSE 0 END)::DOUBLE AS w_{x}" for x in E.LETTERS) + " FROM e GROUP BY object)"
       + " UNION ALL ".join(f"SELECT object, '{k}' AS letters, evidence, w_I, w_P, round(1 / (1 + exp(-({_first(k)[0]} * 0.002::DOUBLE + ln([0.25, 0.5, 1.2, 1.8, 3.0][{_first(k)[1]} + 1]::DOUBLE)))), 6) AS history, round(CASE WHEN evidence > 0 THEN evidence / (evidence + 20) ELSE 0 END, 6) AS confidence FROM s" for k in _KINDS))
def letter_priors(spark, d):
    """What events say of an object by letters, signed and weighted, and how far it favours some readers."""
    c = F.col
    pick = lambda by: F.coalesce(*[F.when(c("event_type") == k, F.lit(v)) for k, v in by.items()])
    events = table(spark, d, "events").select(F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("object"), pick(_ATTITUDE).alias("attitude"), pick(_SAYS).alias("letters"), F.floor("value").cast("int").alias("n"))
    found = E.letter_weights(events, "object", "attitude", "letters", "n")
    rows = found.withColumn("letters", F.explode(F.array(*map(F.lit, _KINDS))))
    at = lambda x: F.get("weights", F.lit(E.LETTERS.index(x)))
    return rows.select("object", "letters", "evidence", at("I").alias("w_I"), at("P").alias("w_P"), F.round(E.history_affinity(c("weights"), c("letters")), 6).alias("history"), F.round(E.evidence_confidence(c("evidence")), 6).alias("confidence"))


@query("""
WITH o AS (SELECT user_id, event_id, event_type <> 'error' AS ok, row_number() OVER w AS p, sum((event_type <> 'error')::INT) OVER w AS wins FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, CASE WHEN NOT ok THEN count(*) FILTER (NOT ok) OVER (PARTITION BY user_id, wins ORDER BY p) END AS in_row FROM o), s AS (SELECT user_id, min(p) AS last FROM r WHERE in_row >= 2 GROUP BY user_id)
SELECT user_id, count(*) AS attempted, count(*) FILTER (ok) AS generated, max(event_id) AS last FROM o LEFT JOIN s USING (user_id) WHERE s.last IS NULL OR p <= s.last GROUP BY user_id""")
def attempts_stopped(spark, d):
    """Each user's events as attempts, which end with the second error in a row."""
    events = table(spark, d, "events").select(F.col("user_id").alias("set"), F.col("event_id").alias("id"), F.col("event_id").alias("position"), (F.col("event_type") != "error").alias("ok"))
    return U.until_stopped(events, 2).groupBy(F.col("set").alias("user_id")).agg(F.count(F.lit(1)).alias("attempted"), F.count_if("ok").alias("generated"), F.max("id").alias("last"))


@query("""
WITH d AS (SELECT source, doc_id, doc_id IN (SELECT doc_id FROM labels) AS is_done FROM documents)
SELECT source, doc_id, is_done, sum(is_done::INT) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS processed, (count(*) OVER (PARTITION BY source) - sum(is_done::INT) OVER (PARTITION BY source ORDER BY doc_id))::BIGINT AS remaining,
min(CASE WHEN NOT is_done THEN doc_id END) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_id FROM d""")
def work_progress(spark, d):
    """How far the labelling of each source is at every document, and which comes next."""
    items = table(spark, d, "documents").select(F.col("source").alias("set"), F.col("doc_id").alias("id"), F.col("doc_id").alias("position"))
    done = table(spark, d, "labels").select(F.col("doc_id").alias("id"))
    return U.progress(items, done).select(F.col("set").alias("source"), F.col("id").alias("doc_id"), "is_done", "processed", "remaining", "next_id")


@query("""
WITH n AS (SELECT l_orderkey AS o_orderkey, count(*) AS lines, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey, o_orderkey % 5 AS stated, coalesce(lines, 0) AS lines, o_totalprice, total FROM orders LEFT JOIN n USING (o_orderkey))
SELECT 'count' AS kind, count(*) FILTER (stated <> lines) AS wrong, 0::BIGINT AS wrong_after, sum(lines)::BIGINT AS sum_after FROM o UNION ALL
SELECT 'price', count(*) FILTER (total IS NOT NULL AND o_totalprice IS DISTINCT FROM total), 0, count(*) FILTER (total IS NOT NULL) FROM o""")
def derived_sync(spark, d):
    """Orders' counts of lines and prices brought in line with the lines: what was wrong, that nothing is when asked again."""
    c = F.col
    lines = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").select("o_orderkey", (c("o_orderkey") % 5).alias("stated"), "o_totalprice")
    children = lines.select(c("l_orderkey").alias("o_orderkey"))
    fixed = Y.recounted(orders, children, ["o_orderkey"], "stated")
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    one = n(Y.miscounted(orders, children, ["o_orderkey"], "stated"), "wrong").join(n(Y.miscounted(fixed, children, ["o_orderkey"], "stated"), "wrong_after")).join(fixed.agg(F.sum("stated").alias("sum_after")))  # one row each
    totals = lines.groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    priced = Y.applied(orders, totals, ["o_orderkey"], "o_totalprice", "total")
    two = n(Y.changes(orders, totals, ["o_orderkey"], "o_totalprice", "total"), "wrong").join(n(Y.changes(priced, totals, ["o_orderkey"], "o_totalprice", "total"), "wrong_after")).join(n(priced.join(totals.select("o_orderkey"), "o_orderkey", "left_semi"), "sum_after"))
    return one.select(F.lit("count").alias("kind"), "wrong", "wrong_after", "sum_after").union(two.select(F.lit("price"), "wrong", "wrong_after", "sum_after"))


_LIST = lambda f, cond="true": "[" + ", ".join(f"coalesce({f}(value) FILTER (b = {i} AND {cond}) / any_value(m), 0.5)" for i in range(8)) + "]"
_LIKE = lambda a, b: f"greatest(0, least(1, 1 - list_sum(list_transform(range(1, 9), lambda i: abs({a}[i] - {b}[i]))) / 8))"


def _axis(kind):
    """The share of each axis that a kind's letters have, as SQL over the object's list v (ni, te, fi, se, ti, ne, si, fe)."""
    parts = []
    for x, (first, (one, other)) in zip(kind, E.AXES.items()):
        a, b = ("(" + " + ".join(f"o.v[{k + 1}]" for k in ks) + ")" for ks in (one, other))
        share = f"CASE WHEN {a} + {b} <= 0 THEN 0.5 ELSE {a} / ({a} + {b}) END"
        parts.append(f"({share})" if x == first else f"(1 - ({share}))")
    return f"greatest(0, least(1, ({' + '.join(parts)}) / 4))"


_COLD = "CASE " + " ".join(f"WHEN letters = '{k}' THEN {_axis(k)} * (1 - trust) + (1 / (1 + exp(-({_first(k)[0]} * 0.002::DOUBLE + ln([0.25, 0.5, 1.2, 1.8, 3.0][{_first(k)[1]} + 1]::DOUBLE))))) * trust" for k in _KINDS) + " END"


@query("""
WITH x AS (SELECT *, (props->>'$.k')::BIGINT AS object, event_id % 8 AS b, greatest(0, coalesce(floor(value)::INT, 0)) AS n FROM events), top AS (SELECT coalesce(nullif(max(value), 0), 1) AS m FROM events),
r AS (SELECT user_id, object, CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE -1 END AS rating FROM x WHERE event_type IN ('purchase', 'click', 'error') AND object IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id, object ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1),
u AS (SELECT user_id, """ + _LIST("avg") + """ AS v, CASE user_id % 4 WHEN 0 THEN 'INTJ' WHEN 1 THEN 'ESFP' WHEN 2 THEN 'ENFJ' END AS letters FROM x, top GROUP BY user_id),
t AS (SELECT user_id, """ + _LIST("avg") + """ AS v FROM x, top WHERE event_type = 'signup' GROUP BY user_id), o AS (SELECT object, """ + _LIST("max") + """ AS v FROM x, top WHERE object IS NOT NULL GROUP BY object),
a AS (SELECT object, """ + _LIST("avg") + """ AS v, least(1, count(*) / 50) AS confidence FROM x, top WHERE event_type = 'purchase' GROUP BY object),
h AS (SELECT object, sum(n)::DOUBLE AS evidence, CASE WHEN sum(n) > 0 THEN sum(n) / (sum(n) + 20) ELSE 0 END AS trust, """ + ", ".join(f"sum(n * CASE {' '.join(f'WHEN event_type = {chr(39)}{k}{chr(39)} THEN {_ATTITUDE[k] * v.count(x)}' for k, v in _SAYS.items())} ELSE 0 END)::DOUBLE AS w_{x}" for x in E.LETTERS) + f""" FROM x GROUP BY object),
z AS (SELECT r.user_id, rating, {_LIKE('u.v', 'o.v')} AS content, {_LIKE('coalesce(t.v, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5])', 'o.v')} AS test, {_LIKE('u.v', 'a.v')} AS audience, {_LIKE('coalesce(t.v, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5])', 'a.v')} AS test_audience, confidence, coalesce({_COLD}, 0.5) AS cold
  FROM r JOIN u USING (user_id) JOIN o USING (object) LEFT JOIN t USING (user_id) LEFT JOIN a USING (object) LEFT JOIN h USING (object)),
y AS (SELECT user_id, rating, content, CASE WHEN confidence IS NULL THEN content ELSE content * (1 - 0.25::DOUBLE * confidence) + audience * 0.25::DOUBLE * confidence END AS b, CASE WHEN confidence IS NULL THEN test ELSE test * (1 - 0.25::DOUBLE * confidence) + test_audience * 0.25::DOUBLE * confidence END AS t, cold FROM z),
l AS (SELECT 'content' AS variant, user_id, rating, round(content, 9) AS score FROM y UNION ALL SELECT 'content_audience', user_id, rating, round(b, 9) FROM y UNION ALL SELECT 'content_audience_test', user_id, rating, round(b * 0.7::DOUBLE + t * 0.2::DOUBLE + 0.05::DOUBLE, 9) FROM y UNION ALL SELECT 'full', user_id, rating, round(b * 0.7::DOUBLE + t * 0.2::DOUBLE + cold * 0.1::DOUBLE, 9) FROM y),
n AS (SELECT variant, user_id, score, count(*) FILTER (rating > 0) AS pos, count(*) FILTER (rating < 0) AS neg FROM l GROUP BY ALL), w AS (SELECT *, sum(neg) OVER (PARTITION BY variant, user_id ORDER BY score) - neg / 2 AS below FROM n),
g AS (SELECT variant, sum(pos) * sum(neg) AS pairs, sum(pos * below) AS wins FROM w GROUP BY variant, user_id), p AS (SELECT variant, sum(pairs)::BIGINT AS pairs, sum(wins) / sum(pairs) AS auc FROM g GROUP BY variant),
s AS (SELECT variant, count(*) FILTER (rating > 0) AS positives, count(*) FILTER (rating < 0) AS negatives, avg(score) FILTER (rating > 0) AS positive_mean, avg(score) FILTER (rating < 0) AS negative_mean FROM l GROUP BY variant)
SELECT variant, positives, negatives, pairs, round(auc, 6) AS auc, round(positive_mean - negative_mean, 6) AS separation, round(positive_mean - negative_mean - (SELECT positive_mean - negative_mean FROM s WHERE variant = 'content'), 6) AS gain FROM s JOIN p USING (variant)""")
def prior_evaluation(spark, d):
    """Latest ratings foretold in four ways: by likeness, with the work's audience, the user's test, and their letters."""
    c = F.col
    raw = table(spark, d, "events")
    pick = lambda by: F.coalesce(*[F.when(c("event_type") == k, F.lit(v)) for k, v in by.items()])
    events = raw.select("user_id", "event_id", "event_type", "ts", "value", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("object"), (c("event_id") % 8).alias("b"))
    top = F.coalesce(F.nullif(raw.agg(F.max("value")).scalar(), F.lit(0.0)), F.lit(1.0))
    vector = lambda df, by, f: df.groupBy(by).agg(F.array(*[f(F.when(c("b") == i, c("value"))) for i in range(8)]).alias("v"), F.count(F.lit(1)).alias("k"))
    scaled = lambda v: F.transform(v, lambda x: F.coalesce(x / c("top"), F.lit(0.5)))
    rating = F.when(c("event_type").isin("purchase", "click"), 1).when(c("event_type") == "error", -1)
    rated = events.withColumn("rating", rating).where("rating is not null and object is not null").groupBy("user_id", "object").agg(F.max_by("rating", F.struct("ts", "event_id")).alias("rating"))
    users = vector(events, "user_id", F.avg).select("user_id", c("v").alias("u"))
    tests = vector(events.where("event_type = 'signup'"), "user_id", F.avg).select("user_id", c("v").alias("t"))
    objects = vector(events.where("object is not null"), "object", F.max).select("object", c("v").alias("o"))
    audience = vector(events.where("event_type = 'purchase' and object is not null"), "object", F.avg).select("object", c("v").alias("a"), F.least(F.lit(1.0), c("k") / 50).alias("confidence"))
    said = events.select("object", pick(_ATTITUDE).alias("attitude"), pick(_SAYS).alias("letters"), F.floor("value").cast("int").alias("n")).where("object is not null")
    history = E.letter_weights(said, "object", "attitude", "letters", "n")
    rows = rated.join(users, "user_id").join(objects, "object").join(tests, "user_id", "left").join(audience, "object", "left").join(history, "object", "left").withColumn("top", top)
    u, o, a = scaled(c("u")), scaled(c("o")), scaled(c("a"))
    t = F.when(c("t").isNull(), F.array_repeat(F.lit(0.5), 8)).otherwise(scaled(c("t")))
    letters = F.when(c("user_id") % 4 == 0, "INTJ").when(c("user_id") % 4 == 1, "ESFP").when(c("user_id") % 4 == 2, "ENFJ")
    trust = E.evidence_confidence(c("evidence"))
    cold = F.when(letters.isNotNull(), E.axis_affinity(o, letters) * (1 - trust) + E.history_affinity(c("weights"), letters) * trust)
    like = S.l1_similarity
    rows = rows.select("user_id", "rating", "confidence", like(u, o).alias("content"), like(t, o).alias("test"), like(u, a).alias("audience"), like(t, a).alias("test_audience"), cold.alias("cold"))
    long = E.prior_variants(rows, ["user_id", "rating"]).withColumn("score", F.round("score", 9))
    out = E.variant_metrics(long, "user_id", "rating", "content")
    return out.select("variant", "positives", "negatives", "pairs", F.round("auc", 6).alias("auc"), F.round("separation", 6).alias("separation"), F.round("gain", 6).alias("gain"))


@query("""
WITH h AS (SELECT doc_id, sha256('split-7:' || doc_id) AS h FROM documents), b AS (SELECT doc_id, row_number() OVER (ORDER BY ('0x' || substr(h, 1, 6))::BIGINT % 4096, h) AS r, count(*) OVER () AS n FROM h)
SELECT doc_id, CASE WHEN r <= round_even(n * 0.1, 0) THEN 'eval' ELSE 'train' END AS part FROM b""")
def exact_split(spark, d):
    """Exactly a tenth of the documents, by hash."""
    return T.exact_split(table(spark, d, "documents").select("doc_id"), "doc_id", 0.1, "split-7")


@query("""
WITH e AS (SELECT user_id, event_id, (props->>'$.k')::DOUBLE AS k, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT c_custkey, c_name, k, value FROM customer JOIN e ON user_id = c_custkey WHERE k IS NOT NULL AND value IS NOT NULL""")
def training_join(spark, d):
    """Customers with the labels of their last event, where it has both."""
    events = table(spark, d, "events").where("user_id is not null")
    note = F.concat(F.lit('{"at":'), F.coalesce("props", F.lit("null")), F.lit(',"value":'), F.coalesce(F.col("value").cast("string"), F.lit("null")), F.lit("}"))
    notes = events.select(F.col("user_id").cast("long").alias("c_custkey"), F.col("event_id").alias("position"), note.alias("note"))
    inputs = table(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name")
    out = T.examples(inputs, notes, "c_custkey", "note", keeper(spark))["examples"]
    return out.select("c_custkey", "c_name", F.try_element_at("labels", F.lit("at.k")).alias("k"), F.try_element_at("labels", F.lit("value")).alias("value"))
