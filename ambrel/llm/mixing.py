"""Mixing sources to target weights by Poisson replication.

A document of source s is repeated Poisson(rate_s) times. The number comes from
inverting the Poisson distribution at a uniform number hashed from seed and id,
so it depends on nothing but the row: a lost task is recomputed alike, and rows
need no coordination. rate_s = budget * w_s / mass_s makes the expected mass of
each source its share w_s of the budget. Copies are then dealt out at random:
hash-partitioned by a random key and sorted by it.

Null sources are one source; a null text has mass 0 and a text of any length its
length; repeated rows of one id, and all rows without id, are repeated alike. A
source without weight has rate 0; an empty table gives no rows. Equal shuffle keys
(copies of repeated rows) stand in any order. Columns ``copy`` and ``shuffle_key``
replace input columns of these names; all others stay, whatever they are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import as_table

SEED, TEMPERATURE = "ambrel-mix", 0.7
#: Distributions go to every task while they have no more bytes than this; beyond, they are joined by salted keys.
BROADCAST_BYTES, SALTS = 32 << 20, 64


def source_rates(docs: DataFrame, by: str = "source", weights: dict | None = None, temperature: float = TEMPERATURE, budget: float | None = None) -> DataFrame:
    """A row for each source: ``by``, mass (characters), rate and cdf, the Poisson distribution up to its far tail.

    Without ``weights`` a source weighs mass ** temperature; without ``budget`` the mass stays as it is.
    """
    mass = docs.groupBy(by).agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("mass"))
    if weights is None:
        weight = F.pow(F.col("mass").cast("double"), F.lit(temperature))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        weight = F.coalesce(F.create_map(*pairs)[F.col(by)], F.lit(0.0))
    mass = as_table(mass.withColumn("weight", weight), "mass")
    total = mass.agg(F.sum("mass").alias("mass"), F.sum("weight").alias("weight")).first()
    scale = (budget if budget is not None else total["mass"] or 0) / (total["weight"] or 1)
    rate = F.round(F.when(F.col("mass") > 0, F.lit(float(scale)) * F.col("weight") / F.col("mass")).otherwise(0.0), 9)
    return with_cdf(mass.select(by, "mass", rate.alias("rate")), by)


def with_cdf(rates: DataFrame, by: str) -> DataFrame:
    """``rates`` with cdf: P(X <= 0), P(X <= 1), ... far enough that the rest is below what a double can tell from 1.

    A row for each number of copies, summed up in order of numbers: work in proportion to the rates.
    """
    rates = as_table(rates, "rates")
    rate, k = F.col("rate"), F.col("k")
    last = F.when(rate > 0, F.ceil(rate + 12 * F.sqrt(rate) + 30)).otherwise(0).cast("int")
    term = F.when(rate > 0, F.exp(k * F.log(rate) - rate - log_factorial(k.cast("double")))).otherwise(1.0)
    terms = rates.select(by, "rate", F.explode(F.sequence(F.lit(0), last)).alias("k")).withColumn("p", term)
    sums = terms.withColumn("c", F.sum("p").over(W.partitionBy(by).orderBy("k")))
    cdf = sums.groupBy(F.col(by).alias("__m_cdf_by")).agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "c"))), lambda x: x["c"]).alias("cdf"))
    return rates.join(cdf, F.col(by).eqNullSafe(F.col("__m_cdf_by"))).drop("__m_cdf_by")


def log_factorial(k: Column) -> Column:
    """ln k!, by Stirling's series ten steps above k."""
    y = k + 11
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5)))
    for i in range(1, 11):
        series = series - F.log(k + i)
    return series


def uniform(seed: str, *cols: str) -> Column:
    """52 bits of an md5 as a number in [0, 1)."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def poisson_replicate(docs: DataFrame, rates: DataFrame, by: str = "source", seed: str = SEED, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with every row repeated; adds copy (int, from 0) and shuffle_key, by which the rows are dealt and sorted."""
    rates = as_table(rates.select(F.col(by).alias("__m_by"), F.col("cdf").alias("__m_cdf")), "distributions")
    size = rates.agg(F.sum(8 * F.size("__m_cdf") + 64 + F.coalesce(F.octet_length(F.col("__m_by").cast("string")), F.lit(0))).alias("b")).first()["b"] or 0
    if size <= BROADCAST_BYTES:
        joined = docs.join(F.broadcast(rates), F.col(by).eqNullSafe(F.col("__m_by")))
    else:
        salted = rates.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__m_salt"))
        dealt = docs.withColumn("__m_own", F.pmod(F.xxhash64(F.col(doc_id)), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, F.col(by).eqNullSafe(F.col("__m_by")) & (F.col("__m_own") == F.col("__m_salt"))).drop("__m_salt", "__m_own")
    u = uniform(seed, doc_id)
    times = F.size(F.filter("__m_cdf", lambda c: c <= u))
    out = joined.withColumn("__m_n", times).where("__m_n > 0").withColumn("copy", F.explode(F.expr("sequence(0, __m_n - 1)")))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("place"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.col("copy").cast("string")))
    out = out.withColumn("shuffle_key", key).drop("__m_by", "__m_cdf", "__m_n")
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return poisson_replicate(docs, source_rates(docs))


SQL = f"""
WITH m AS (SELECT source, sum(coalesce(length(text), 0))::BIGINT AS mass FROM documents GROUP BY source),
t AS (SELECT sum(mass) AS mass, sum(pow(mass::DOUBLE, {TEMPERATURE})) AS weight FROM m),
r AS (SELECT source, CASE WHEN m.mass > 0 THEN round(t.mass / t.weight * pow(m.mass::DOUBLE, {TEMPERATURE}) / m.mass, 9) ELSE 0 END AS rate FROM m, t),
p AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM r WHERE rate > 0),
c AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
l AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM c GROUP BY source),
d AS (SELECT d.*, unnest(range(0, len(list_filter(l.cdf, lambda x: x <= ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::UBIGINT::DOUBLE / {float(2**52)!r})))) AS copy
      FROM documents d JOIN l ON d.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, md5('{SEED}:place:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy) AS shuffle_key FROM d"""
