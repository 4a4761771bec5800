"""Training sets: inputs joined with their last annotation, exact seeded splits, padded batches, a linear baseline.

Nothing here is ordered as a whole: an exact split ranks rows in one of BUCKETS buckets of a hash alone, batches are made of a
task's rows as they come. The baseline is Spark ML's hashed term counts with one linear regression a label.
"""

from __future__ import annotations

import dataclasses

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .nested import numeric_leaves

BUCKETS = 4096


def last_annotations(annotations: DataFrame, by: str) -> DataFrame:
    """Of each ``by`` the annotation with the greatest position; rows without one are none."""
    last = W.partitionBy(by).orderBy(F.desc("position"))
    return annotations.where(F.col(by).isNotNull()).withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r")


def examples(inputs: DataFrame, annotations: DataFrame, by: str, target: str, keep) -> dict[str, DataFrame]:
    """examples (``by``, labels: name -> number, with the inputs' columns) and problems (``by``, problem, detail).

    ``annotations`` has ``by``, position and JSON in ``target``, whose numbers within objects are the labels, by path. Problems
    are inputs without an annotation, annotations without a number, and examples whose labels are not the commonest set.
    """
    last = keep(last_annotations(annotations.select(by, "position", target), by))
    numbers = numeric_leaves(last, [by], target, keep)
    labels = numbers.groupBy(by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("path", "value")))).alias("labels")).withColumn("names", F.array_join(F.map_keys("labels"), ","))
    joined = keep(inputs.join(last.select(by, F.lit(True).alias("annotated")), by, "left").join(labels, by, "left"))
    usual = joined.where("names is not null").groupBy("names").agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("names", F.struct("n", "names")).alias("usual"))  # one row
    judged = joined.join(F.broadcast(usual))
    problem = F.when(F.col("annotated").isNull(), "no_annotation").when(F.col("names").isNull(), "no_label").when(F.col("names") != F.col("usual"), "other_labels")
    return {
        "examples": judged.where(problem.isNull()).select(*inputs.columns, "labels"),
        "problems": judged.withColumn("problem", problem).where("problem is not null").select(by, "problem", F.when(F.col("problem") == "other_labels", F.col("names")).alias("detail")),
    }


def held_out(n: int, ratio: float) -> int:
    """How many of ``n`` are held out: the rounded share, one at least, and one where that would be all."""
    size = max(1, round(n * ratio))
    return min(n, 1 if size >= n else size)


def exact_split(rows: DataFrame, key: str, ratio: float, seed: str, group: str | None = None) -> DataFrame:
    """``rows`` with part: 'eval' for exactly held_out() of them, those with the smallest hashes of seed and key, else 'train'.

    With ``group`` whole groups are dealt, held_out() of the groups. Keys must be unique (without ``group``): rows alike in
    hash and key are ranked in any order. Null keys are hashed as the text "null".
    """
    unit = group or key
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(unit).cast("string"), F.lit("null")))
    digest = F.sha2(text, 256)
    bucket = (F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % BUCKETS).cast("int")
    hashed = (rows.select(unit).distinct() if group else rows).withColumns({"__h": digest, "__b": bucket})
    counts = {r["__b"]: r["n"] for r in hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("n")).collect()}  # BUCKETS rows at most
    left, edge = held_out(sum(counts.values()), ratio), -1
    for edge in sorted(counts):
        if counts[edge] >= left:
            break
        left -= counts[edge]
    on_edge = hashed.where(F.col("__b") == edge).withColumn("__r", F.row_number().over(W.partitionBy("__b").orderBy("__h", unit))).withColumn("part", F.when(F.col("__r") <= left, "eval").otherwise("train"))
    others = hashed.where(F.col("__b") != edge).withColumn("part", F.when(F.col("__b") < edge, "eval").otherwise("train"))
    out = on_edge.drop("__r").unionByName(others).drop("__h", "__b")
    return out if not group else rows.join(out.withColumnRenamed(unit, "__g"), F.col(unit).eqNullSafe(F.col("__g"))).drop("__g")


def padded_batches(rows: DataFrame, key: str, tokens: str, size: int, pad: int = 0) -> DataFrame:
    """batch (a number within its task), ids, tokens and mask: up to ``size`` rows of a task, padded to the longest of them."""
    kind = dict(rows.dtypes)[key]

    def run(frames):
        held, batch = [], 0

        def made(held, batch):
            width = max((len(t) for _, t in held), default=0)
            lists = [([*t, *[pad] * (width - len(t))], [1] * len(t) + [0] * (width - len(t))) for _, t in held]
            return pd.DataFrame({"batch": [batch], "ids": [[k for k, _ in held]], "tokens": [[t for t, _ in lists]], "mask": [[m for _, m in lists]]})

        for frame in frames:
            for k, t in zip(frame[key], frame[tokens]):
                held.append((k, [] if t is None else [int(x) for x in t]))
                if len(held) == size:
                    yield made(held, batch)
                    held, batch = [], batch + 1
        if held:
            yield made(held, batch)

    return rows.select(key, tokens).mapInPandas(run, f"batch long, ids array<{kind}>, tokens array<array<int>>, mask array<array<int>>")


@dataclasses.dataclass
class Baseline:
    """One linear regression a label over hashed term counts."""

    labels: list[str]
    features: object
    models: dict

    def predict(self, rows: DataFrame, text: str = "text") -> DataFrame:
        """``rows`` with predicted: label -> number within [0, 1]."""
        out = self.features.transform(rows.withColumn("__text", F.coalesce(text, F.lit(""))))
        for i, name in enumerate(self.labels):
            out = self.models[name].setPredictionCol(f"__p{i}").transform(out)
        clamped = lambda i: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(f"__p{i}")))
        pairs = F.create_map(*[x for i, name in enumerate(self.labels) for x in (F.lit(name), clamped(i))])
        return out.select(*rows.columns, pairs.alias("predicted"))


def fit_baseline(train: DataFrame, labels: list[str], text: str = "text", features: int = 1 << 12, strength: float = 0.1) -> Baseline:
    """Fit on ``train`` (text, labels: name -> number); a row without a label takes no part in that label's fit."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import HashingTF, RegexTokenizer
    from pyspark.ml.regression import LinearRegression

    steps = [RegexTokenizer(inputCol="__text", outputCol="__words", pattern=r"\s+"), HashingTF(inputCol="__words", outputCol="__terms", numFeatures=features, binary=True)]
    rows = train.withColumn("__text", F.coalesce(text, F.lit("")))
    made = Pipeline(stages=steps).fit(rows)
    ready = made.transform(rows).select("__terms", "labels")
    fit = lambda name: LinearRegression(featuresCol="__terms", labelCol="__y", regParam=strength, solver="l-bfgs", maxIter=30).fit(ready.withColumn("__y", F.try_element_at("labels", F.lit(name))).where("__y is not null"))
    return Baseline(labels, made, {name: fit(name) for name in labels})


def errors(predicted: DataFrame) -> DataFrame:
    """(label, n, mse, mae) of rows with labels and predicted."""
    pair = predicted.select(F.explode(F.map_entries("labels")).alias("e"), "predicted").select(F.col("e.key").alias("label"), (F.try_element_at("predicted", F.col("e.key")) - F.col("e.value")).alias("d")).where("d is not null")
    return pair.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("d") * F.col("d")).alias("mse"), F.avg(F.abs("d")).alias("mae"))


def jitter(seed: Column, scale: float) -> Column:
    """A number in [-scale / 2, scale / 2] that a text's SHA-256 decides."""
    return (F.conv(F.substring(F.sha2(seed, 256), 1, 8), 16, 10).cast("long") / F.lit(4294967295.0) - 0.5) * scale
