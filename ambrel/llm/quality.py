"""Quality rules with risk-controlled cutoffs (DataFrame functions only).

Every rule is a ratio in per mille, computed with integer division so that all
engines agree, and a ladder of fixed cutoffs from lenient to strict. Documents
labelled good are the holdout. Within a stratum, a cutoff is *safe* when the
exact binomial test rejects "this cutoff turns away more than
``alpha / #rules`` of the good documents" at level
``delta / (#strata * #rules)`` (Bonferroni over strata and rules). The ladder is
walked as a fixed sequence: the strictest cutoff before the first failure is
taken, so no further correction is needed along the ladder. With probability
``1 - delta``, in every stratum at most ``alpha`` of good documents are turned
away. A stratum with too few labels gets no cutoff and loses nothing.

Null texts count as empty, texts of any length are read whole; null strata are a
stratum of their own, null ids never match a label; repeated rows are judged alike,
and rows exactly at a cutoff are kept. Without labels, or on an empty table, no
cutoff is safe and the base rules alone judge. Computed columns replace input
columns of the same names; all others stay, whatever they are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import as_table, let

#: A rule's numerator, denominator and cutoffs in per mille, lenient first.
#: A negative sign in front of a rule turns "more than" into "less than".
RULES = {
    "symbols": ("n_symbols", "word_chars", (400, 300, 200, 150, 100, 70, 50)),
    "dup_lines": ("n_dup_lines", "n_lines", (800, 700, 600, 500, 400, 300, 200)),
    "repeats": ("n_repeat_words", "n_words", (290, 260, 230, 200, 170, 140, 110)),
    "long_words": ("word_chars", "n_words", (20000, 16000, 14000, 12000, 11000, 10000, 9000)),
    "-short_words": ("word_chars", "n_words", (-1500, -2000, -2500, -2800, -3000, -3200, -3400)),
}
ALPHA, DELTA, WINDOW = 0.02, 0.05, 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SPACE = r"[\x20\x09-\x0D]"


def _repeated(words: Column) -> Column:
    """Words that lie in windows of WINDOW words found twice or more in the text."""

    def covered(hashes: Column) -> Column:
        def runs(pairs: Column) -> Column:
            def is_twin(p, i):
                before = F.when(i > 0, F.get(pairs, i - 1)["h"] == p["h"])
                after = F.when(i < F.size(pairs) - 1, F.get(pairs, i + 1)["h"] == p["h"])
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            starts = F.sort_array(F.transform(F.filter(pairs, is_twin), lambda p: p["i"]))
            zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
            add = lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last"))
            return F.aggregate(starts, zero, add, lambda a: a["n"])

        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(pairs, runs)).otherwise(0)

    def of(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        return F.when(n > WINDOW, let(hashes, covered)).otherwise(0)

    return of(words)


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long).

    A row's windows are compared by 64-bit hashes within its own array: nothing is shuffled.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    flat = F.trim(F.regexp_replace(t, SPACE + "+", " "))

    def measures(w: Column) -> Column:
        return F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("c"), _repeated(w).alias("r"))

    words = F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    both = lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"))
    made = F.struct(let(words, measures).alias("w"), let(lines, both).alias("l"), F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).alias("s"))
    out = docs.withColumn("__q", F.explode(F.array(made)))  # one row; a filter on the results does not repeat the expressions
    cols = {"n_words": "__q.w.n", "word_chars": "__q.w.c", "n_symbols": "__q.s", "n_lines": "__q.l.n", "n_dup_lines": "__q.l.d", "n_repeat_words": "__q.w.r"}
    return out.withColumns({k: F.col(v).cast("long") for k, v in cols.items()}).drop("__q")


def signal(rule: str) -> Column:
    """The rule's value in per mille; a row is turned away above its cutoff."""
    top, bottom, _ = RULES[rule]
    ratio = F.expr(f"(1000 * {top}) div greatest({bottom}, 1)")
    return -ratio if rule[0] == "-" else ratio


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _lgamma(x: Column) -> Column:
    """ln gamma(x) for x >= 1, by Stirling's series ten steps above x."""
    y = x + 10
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5)))
    steps = F.log(x)
    for k in range(1, 10):
        steps = steps + F.log(x + k)
    return series - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact but for rounding; 1 where k >= n p, where no bound can hold.

    Terms are summed downwards from k until they no longer count: O(sqrt(n)) of them.
    """
    kd, nd = k.cast("double"), n.cast("double")
    first = F.exp(_lgamma(nd + 1) - _lgamma(kd + 1) - _lgamma(nd - kd + 1) + kd * math.log(p) + (nd - kd) * math.log1p(-p))
    ratio = kd * (1 - p) / ((nd - kd + 1) * p)
    enough = F.least(kd, F.ceil(42 / -F.log(F.least(ratio, F.lit(1 - 1e-9))))).cast("int")
    terms = F.when(kd > 0, F.sequence(F.lit(0), enough)).otherwise(F.array(F.lit(0)))
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))
    step = lambda a, j: F.struct((a["t"] * (kd - j) * (1 - p) / ((nd - kd + j + 1) * p)).alias("t"), (a["s"] + a["t"]).alias("s"))
    total = F.aggregate(terms, zero, step, lambda a: a["s"])
    return F.when(kd >= nd * p, 1.0).otherwise(F.least(F.lit(1.0), first * total))


def fit(rows: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row a stratum: ``stratum`` and a cutoff for every rule (null: none is safe).

    ``rows``: doc_id, the stratum and features(); ``labels``: doc_id and quality (1: good). A document
    is good if any of its labels says so. Rows that fail the base rules take no part.
    """
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    ladder = F.array(*[F.struct(F.lit(r).alias("rule"), signal(r).alias("v"), F.array(*map(F.lit, RULES[r][2])).alias("cuts")) for r in RULES])
    held = rows.where(~base_failed()).join(good, "doc_id").select(F.col(stratum).alias("stratum"), F.explode(ladder).alias("x"))
    passed = F.size(F.filter(F.col("x.cuts"), lambda c: F.col("x.v") > c))  # a ladder falls, so these are its last cutoffs
    counts = held.select("stratum", F.col("x.rule").alias("rule"), F.col("x.cuts").alias("cuts"), passed.alias("over"))
    steps = len(next(iter(RULES.values()))[2])
    sums = counts.groupBy("stratum", "rule", "cuts").agg(F.count(F.lit(1)).alias("n"), *[F.sum((F.col("over") >= steps - i).cast("long")).alias(f"k{i}") for i in range(steps)])
    sums = as_table(sums, "holdout")  # a row for each stratum and rule
    level = delta / len(RULES) / max(1, sums.select("stratum").distinct().count())
    safe = F.array(*[binomial_tail(F.col(f"k{i}"), F.col("n"), alpha / len(RULES)) <= level for i in range(steps)])
    last = F.aggregate(safe, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, ok: F.struct((a["n"] + (a["on"] & ok).cast("int")).alias("n"), (a["on"] & ok).alias("on")), lambda a: a["n"])
    chosen = sums.select("stratum", "rule", F.when(last > 0, F.element_at("cuts", F.greatest(last, F.lit(1)))).alias("cut"))
    return chosen.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES])


def judge(rows: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """``rows`` with base_failed and kept; ``cuts``: what fit() gave, as a table of known size."""
    named = cuts.select(F.col("stratum").alias("__q_stratum"), *[F.col(f"`cut_{r}`").alias(f"__q_cut_{i}") for i, r in enumerate(RULES)])
    over = F.lit(False)
    for i, r in enumerate(RULES):
        over = over | F.coalesce(signal(r) > F.col(f"__q_cut_{i}"), F.lit(False))
    joined = rows.join(named, F.col(stratum).eqNullSafe(F.col("__q_stratum")), "left")
    out = joined.withColumns({"base_failed": base_failed(), "kept": ~(base_failed() | over)})
    return out.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*rows.columns, "base_failed", "kept"])])


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``docs`` with features, base_failed and kept.

    Cutoffs are fitted on a table of the features alone; the judging pass makes them again, so no text is written or
    shuffled.
    """
    rows = as_table(features(docs).select("doc_id", stratum, *BASE, "n_lines"), "quality")
    cuts = as_table(fit(rows, labels, stratum, alpha, delta), "cutoffs")
    return judge(features(docs), cuts, stratum)


def _sql() -> str:
    value = lambda r: f"{'-' if r[0] == '-' else ''}((1000 * {RULES[r][0]}) // greatest({RULES[r][1]}, 1))"
    tests = " UNION ALL ".join(f"SELECT lang, '{r}' AS rule, {i} AS step, {c} AS cut, count(*) AS n, count(*) FILTER ({value(r)} > {c}) AS k FROM held GROUP BY lang" for r in RULES for i, c in enumerate(RULES[r][2]))
    p = ALPHA / len(RULES)
    over = " OR ".join(f"coalesce({value(r)} > (SELECT c.cut FROM cuts c WHERE c.rule = '{r}' AND c.lang IS NOT DISTINCT FROM f.lang), false)" for r in RULES)
    return f"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, words FROM w WHERE len(words) > 8),
h AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram FROM g),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM h) WHERE c > 1),
r AS (SELECT doc_id, sum(least(8, i - coalesce(before, i - 8))) AS n_repeat_words
      FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM d) GROUP BY doc_id),
f AS (SELECT w.doc_id, lang, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
      (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING max(quality) = 1),
held AS (SELECT b.* FROM b JOIN good USING (doc_id) WHERE NOT base_failed),
tests AS ({tests}),
p AS (SELECT *, CASE WHEN k >= n * {p!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
      lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p!r}) + (n - i) * ln(1 - {p!r})))) END AS p,
      (SELECT count(*) FROM (SELECT DISTINCT lang FROM held)) AS n_strata FROM tests),
bad AS (SELECT lang, rule, min(CASE WHEN p * n_strata > {DELTA / len(RULES)!r} THEN step ELSE 99 END) AS first_bad FROM p GROUP BY lang, rule),
cuts AS (SELECT p.lang, p.rule, p.cut FROM p JOIN bad ON p.rule = bad.rule AND p.lang IS NOT DISTINCT FROM bad.lang
      WHERE p.step = least(first_bad, {len(next(iter(RULES.values()))[2])}) - 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR {over}) AS kept FROM b f"""


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = as_table(features(docs).select("doc_id", "lang", *BASE, "n_lines"), "quality")
    cuts = as_table(fit(rows, labels), "cutoffs")
    return judge(rows, cuts).select("doc_id", *BASE, "base_failed", "kept")


SQL = _sql()
