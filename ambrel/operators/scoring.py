"""Rule scoring of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyword_scores(df: DataFrame, text: Column, rules: list[tuple[list[str], str, float]]) -> DataFrame:
    """``df`` with a column for each dimension: the score of the last rule with a term in the text, else null."""
    out = {}
    for terms, dimension, score in rules:
        hit = F.exists(F.array(*map(F.lit, terms)), lambda t: F.contains(text, t))
        out[dimension] = F.when(hit, score).otherwise(out.get(dimension, F.lit(None).cast("double")))
    return df.withColumns(out)


def confidence(lengths: Column, cap: int = 120, scale: int = 900, base: float = 0.48, top: float = 0.9, none: float = 0.35) -> Column:
    """Grows with the capped lengths of the facts found."""
    total = F.aggregate(F.transform(lengths, lambda n: F.least(n, F.lit(cap))), F.lit(0), lambda a, n: a + n)
    return F.when(F.size(lengths) == 0, none).otherwise(F.round(F.least(F.lit(top), base + total / scale), 2))


def best_evidence(facts: Column, terms: list[str]) -> Column:
    """Index of the fact with most terms, then the longest up to 80, then the first; null without facts."""
    hits = lambda f: sum((F.contains(f, F.lit(t)).cast("int") for t in terms), F.lit(0))
    keys = F.transform(facts, lambda f, i: F.struct(hits(f).alias("h"), F.least(F.length(f), F.lit(80)).alias("n"), (-i).alias("i")))
    return -F.array_max(keys)["i"]
