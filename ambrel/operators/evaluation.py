"""Calibration, ranking quality, regression metrics, and priors blended by evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalar import clamp

#: Letters with their opposites side by side, and the axes of eight traits (ni, te, fi, se, ti, ne, si, fe) by first letter.
LETTERS = "IENSTFJP"
AXES = {"I": ((0, 6, 4, 2), (5, 3, 1, 7)), "N": ((0, 5), (6, 3)), "T": ((4, 1), (2, 7)), "J": ((0, 6, 1, 7), (5, 3, 4, 2))}
TIERS = (0.25, 0.5, 1.2, 1.8, 3.0)


def calibrated(df: DataFrame, value: str, floor: float = 0.025, stretch: float = 1.15) -> DataFrame:
    """``df`` with score = .1 + .8 / (1 + exp(-z)), z from population mean and deviation of the whole table (one row, broadcast)."""
    stats = df.agg(F.avg(value).alias("__mean"), F.stddev_pop(value).alias("__sd")).first()
    mean, sd = stats["__mean"] or 0.0, max(stats["__sd"] or 0.0, floor)
    z = (F.col(value) - F.lit(float(mean))) / F.lit(stretch * sd)
    return df.withColumn("score", F.round(0.1 + 0.8 / (1 + F.exp(-z)), 4))


def group_auc(df: DataFrame, by: str | list[str], score: str, positive: Column) -> DataFrame:
    """Pairs, wins (ties half) and AUC within groups, from running counts: no pair of rows is ever made.

    Rows are first summed by score, so a group is as large as its distinct scores.
    """
    by = [by] if isinstance(by, str) else by
    sums = df.groupBy(*by, score).agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    below = F.sum("neg").over(W.partitionBy(*by).orderBy(score).rowsBetween(W.unboundedPreceding, W.currentRow))
    wins = F.sum(F.col("pos") * (F.col("below") - F.col("neg") / 2))
    out = sums.withColumn("below", below).groupBy(*by).agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), wins.alias("wins"))
    pairs = F.col("positives") * F.col("negatives")
    return out.where(pairs > 0).select(*by, pairs.alias("pairs"), F.col("wins").cast("double").alias("wins"), F.round(F.col("wins") / pairs, 6).alias("auc"))


def long_variants(df: DataFrame, keys: list[str], variants: dict[str, Column]) -> DataFrame:
    """One row for each variant of a score."""
    pairs = F.array(*[F.struct(F.lit(k).alias("variant"), v.alias("score")) for k, v in variants.items()])
    return df.select(*keys, F.explode(pairs).alias("v")).select(*keys, "v.variant", "v.score")


def logistic_score(z: Column) -> Column:
    """.1 to .9 along the logistic curve."""
    return 0.1 + 0.8 / (1 + F.exp(-z))


def audience_aware(content: Column, audience: Column, confidence: Column, share: float = 0.25) -> Column:
    """Content's likeness with up to ``share`` of the audience's, as far as that is to be trusted."""
    weight = share * clamp(confidence)
    return content * (1 - weight) + audience * weight


def evidence_confidence(weight: Column, prior: float = 20.0) -> Column:
    """How far evidence of a weight outdoes the prior's; none without evidence."""
    return F.when(weight > 0, clamp(weight / (weight + prior))).otherwise(0.0)


def axis_affinity(traits: Column, letters: Column) -> Column:
    """Mean over the axes of the share that each of four letters has; 0.5 for other than eight traits or four letters."""
    parts = []
    for i, (first, (one, other)) in enumerate(AXES.items()):
        a, b = (sum((F.get(traits, F.lit(k)) for k in ks), F.lit(0.0)) for ks in (one, other))
        share = F.when(a + b <= 0, 0.5).otherwise(a / (a + b))
        parts.append(F.when(F.substring(F.upper(letters), i + 1, 1) == first, share).otherwise(1 - share))
    fits = (F.size(traits) == 8) & (F.length(letters) == 4)
    return F.when(fits, clamp(sum(parts) / 4)).otherwise(0.5)


def letter_weights(rows: DataFrame, by: str, attitude: str, letters: str, count: str) -> DataFrame:
    """``by``, weights (of each of LETTERS: attitude times count, summed) and evidence (the counts' sum); counts below 0 count 0.

    A letter that stands twice in a row's letters counts twice; others than LETTERS add nothing but evidence.
    """
    n = F.greatest(F.coalesce(count, F.lit(0)), F.lit(0)).cast("double")
    signed = F.coalesce(attitude, F.lit(0)) * n
    times = lambda x: F.length(F.upper(F.coalesce(letters, F.lit("")))) - F.length(F.replace(F.upper(F.coalesce(letters, F.lit(""))), F.lit(x), F.lit("")))
    sums = rows.groupBy(by).agg(*[F.sum(signed * times(x)).alias(x) for x in LETTERS], F.sum(n).alias("evidence"))
    return sums.select(by, F.array(*LETTERS).alias("weights"), "evidence")


def history_affinity(weights: Column, letters: Column) -> Column:
    """Each letter's weight against its opposite's, with a tier by how many of the letters lead, on the logistic curve."""
    upper = F.split(F.upper(letters), "")
    lead = F.transform(upper, lambda x: _lead(weights, x))
    signal = F.aggregate(lead, F.lit(0.0), lambda s, d: s + d)
    leading = F.size(F.filter(lead, lambda d: d > 0))
    tier = F.element_at(F.array(*map(F.lit, TIERS)), F.least(leading, F.lit(4)) + 1)
    return 1 / (1 + F.exp(-(signal * 0.002 + F.log(tier))))


def _lead(weights: Column, letter: Column) -> Column:
    """A letter's weight less its opposite's; 0 for what is no letter of LETTERS."""
    at = F.instr(F.lit(LETTERS), letter) - 1
    other = F.when(at % 2 == 0, at + 1).otherwise(at - 1)
    return F.when((letter != "") & (at >= 0), F.get(weights, at) - F.get(weights, other)).otherwise(0.0)


def prior_variants(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, variant and score of four ways to foretell a rating, each row once for each.

    ``rows`` has content (likeness of user and work), test (the same by the user's test), audience, test_audience and
    confidence (of the work's audience, null without one) and cold (of user's letters and work, null without letters).
    """
    c = F.col
    aware = lambda x, y: F.when(c("confidence").isNotNull(), audience_aware(c(x), c(y), c("confidence"))).otherwise(c(x))
    behaviour, test, cold = aware("content", "audience"), aware("test", "test_audience"), F.coalesce("cold", F.lit(0.5))
    return long_variants(rows, keys, {"content": c("content"), "content_audience": behaviour, "content_audience_test": behaviour * 0.7 + test * 0.2 + 0.05, "full": behaviour * 0.7 + test * 0.2 + cold * 0.1})


def variant_metrics(long: DataFrame, user: str, rating: str, base: str) -> DataFrame:
    """A row for each variant: counts and means of good and bad ratings' scores, their separation and its gain over ``base``,
    pairs within users and the share of them that are ordered right (ties half); null where there is nothing to compare."""
    good, bad = F.col(rating) > 0, F.col(rating) < 0
    rated = long.where(good | bad)
    mean = lambda cond: F.avg(F.when(cond, F.col("score")))
    sums = rated.groupBy("variant").agg(F.count_if(good).alias("positives"), F.count_if(bad).alias("negatives"), mean(good).alias("positive_mean"), mean(bad).alias("negative_mean"))
    auc = group_auc(rated, ["variant", user], "score", good).groupBy("variant").agg(F.sum("pairs").alias("pairs"), (F.sum("wins") / F.sum("pairs")).alias("auc"))
    out = sums.join(auc, "variant", "left").withColumn("separation", F.col("positive_mean") - F.col("negative_mean"))
    against = out.where(F.col("variant") == base).agg(F.max("separation").alias("__base"))  # one row
    return out.join(F.broadcast(against)).withColumn("gain", F.col("separation") - F.col("__base")).withColumn("pairs", F.coalesce("pairs", F.lit(0))).drop("__base")
