"""Resumable work in sets: what is left, how far it is, and attempts that stop after failures in a row.

A set's items are attempted in their order; one that fails is left for another run, ``stop`` in a row end the set's run. What is
done is a table that grows by each run's results, so a run that is killed repeats no item whose result was written.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.scratch import keeper


def progress(items: DataFrame, done: DataFrame, by: str = "set", keep=None) -> DataFrame:
    """``items`` (set, id, position) with is_done, processed and remaining up to each, and next_id: the first later one that is not done.

    Items are dealt in order over tasks, each counts its own stretch of a set, and the stretches' sums are added: a set may be
    of any size.
    """
    c, last = F.col, lambda x: F.last(x, ignorenulls=True)
    flagged = items.join(done.select("id").distinct().withColumn("is_done", F.lit(True)), "id", "left").withColumn("is_done", F.coalesce("is_done", F.lit(False)))
    ordered = flagged.repartitionByRange(by, "position", "id").withColumn("__at", F.spark_partition_id())
    ordered = (keep or keeper(items.sparkSession))(ordered)
    left = F.when(~c("is_done"), c("id"))
    # what comes later is what came before in the reverse order: a frame that ends at the last row is read anew for each row
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    parts = ordered.groupBy(by, "__at").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_done").alias("k"), F.min(F.when(left.isNotNull(), F.struct("position", "id")))["id"].alias("first"))
    of_set = W.partitionBy(by)
    parts = parts.select(by, "__at", F.coalesce(F.sum("k").over(before(of_set.orderBy("__at"))), F.lit(0)).alias("__k"), F.sum("n").over(of_set).alias("__n"), last("first").over(before(of_set.orderBy(F.desc("__at")))).alias("__next"))
    within = W.partitionBy(by, "__at")
    processed = F.sum(c("is_done").cast("long")).over(within.orderBy("position", "id").rowsBetween(W.unboundedPreceding, W.currentRow))
    later = last(left).over(before(within.orderBy(F.desc("position"), F.desc("id"))))
    rows = ordered.select("*", processed.alias("__processed"), later.alias("__later"))
    rows = rows.withColumn("__set", F.struct(by)).join(parts.select(F.struct(by).alias("__set"), "__at", "__k", "__n", "__next"), ["__set", "__at"])
    done_now = c("__k") + c("__processed")
    return rows.select(*items.columns, "is_done", done_now.alias("processed"), (c("__n") - done_now).alias("remaining"), F.coalesce("__later", "__next").alias("next_id"))


def remaining(items: DataFrame, done: DataFrame, most: int | None = None, by: str = "set") -> DataFrame:
    """Items that are not done, the first ``most`` of each set in order."""
    left = items.join(done.select("id").distinct(), "id", "left_anti").select(*items.columns)
    if most is None:
        return left
    return left.withColumn("__r", F.row_number().over(W.partitionBy(by).orderBy("position", "id"))).where(F.col("__r") <= most).drop("__r")


def until_stopped(outcomes: DataFrame, stop: int = 3, by: str = "set") -> DataFrame:
    """``outcomes`` (set, id, position, ok) up to and with the ``stop``-th failure in a row of their set.

    A run of failures is what lies behind one number of successes, so a failure's place in its run is its rank there.
    """
    order = W.partitionBy(by).orderBy("position", "id")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    ok = F.coalesce("ok", F.lit(False))
    runs = outcomes.withColumn("__wins", F.sum(ok.cast("int")).over(upto))
    failed = F.row_number().over(W.partitionBy(by, "__wins").orderBy("position", "id")) - F.when(F.col("__wins") > 0, 1).otherwise(0)  # behind the win itself
    ended = F.max(F.when(~ok & (F.col("__in_row") >= stop), 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, -1))
    return runs.withColumn("__in_row", failed).withColumn("__ended", F.coalesce(ended, F.lit(0))).where("__ended = 0").select(*outcomes.columns)


def attempted(items: DataFrame, attempt, result: str = "result string", stop: int = 3, by: str = "set") -> DataFrame:
    """Each set's items in order, with ok, error and what ``attempt(row)`` gives, until ``stop`` fail in a row.

    Sets are dealt to tasks; a task reads its sets as a stream, so a set may be of any size. ``attempt`` takes a row as a
    dict, returns the result's columns as a dict or raises; an exception is the item's failure, told as its text.
    """
    names = [f.strip().split(" ")[0] for f in result.split(",")]

    def run(frames):
        current, failures = object(), 0
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                if row[by] != current:
                    current, failures = row[by], 0
                if failures >= stop:
                    continue
                try:
                    out.append(row | {n: None for n in names} | attempt(row) | {"ok": True, "error": None})
                    failures = 0
                except Exception as error:  # what an attempt raises is its outcome
                    out.append(row | {n: None for n in names} | {"ok": False, "error": f"{type(error).__name__}: {error}"})
                    failures += 1
            yield pd.DataFrame(out, columns=[*frame.columns, *names, "ok", "error"])

    kinds = ", ".join(f"`{n}` {k}" for n, k in items.dtypes)
    return items.repartition(by).sortWithinPartitions(by, "position", "id").mapInPandas(run, f"{kinds}, {result}, ok boolean, error string")


def told(items: DataFrame, outcomes: DataFrame, done: DataFrame, by: str = "set") -> DataFrame:
    """A row for each set: status, attempted, generated and failed this run, processed, remaining and total."""
    run = outcomes.groupBy(by).agg(F.count(F.lit(1)).alias("attempted"), F.count_if("ok").alias("generated"))
    whole = items.join(done.select("id").distinct().withColumn("d", F.lit(1)), "id", "left").groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count("d").alias("processed"))
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = whole.join(run, by, "left").select(by, n("attempted"), n("generated"), "processed", "total")
    status = F.when(F.col("processed") == F.col("total"), "completed").otherwise("in_progress")
    return out.select(by, status.alias("status"), "attempted", "generated", (F.col("attempted") - F.col("generated")).alias("failed"), "processed", (F.col("total") - F.col("processed")).alias("remaining"), "total")
