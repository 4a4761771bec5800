"""Structured Streaming over files: distinct events, windowed counts, upserted snapshots.

distinct() is over all time: its state, a key each in the checkpoint, grows with the distinct keys and loses no row,
however late or without time. distinct_within() and window_counts() bound their state by a watermark and drop what comes
later; a watermark begins at 1970, so rows up to then, and rows without time, count as late from the second batch on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, path: str, schema, per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files that come under ``path``, a folder or a pattern (as which a lone file must be given)."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(path)


def _timed(stream: DataFrame, time: str, late: str) -> DataFrame:
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)  # times without zone are the session's


def distinct(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key there ever was, over all batches and restarts. Null keys are a key."""
    return stream.dropDuplicates(keys)


def distinct_within(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """The first row of each key; a key is forgotten, and a row dropped, once it is ``late`` behind the newest row."""
    return _timed(stream, time, late).dropDuplicatesWithinWatermark(keys)


def window_counts(stream: DataFrame, time: str, late: str, width: str, by: list[str], value: str) -> DataFrame:
    """start, the group, n and total for each window of ``width``; rows beyond ``late`` are dropped."""
    counts = _timed(stream, time, late).groupBy(F.window(time, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return counts.select(F.col("w.start").alias("start"), *by, "n", "total")


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all there is now to the Parquet files of ``path``, each input once, resuming from ``checkpoint``."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()


def each_batch(stream: DataFrame, apply, checkpoint: str, mode: str = "append") -> None:
    """``apply(rows, batch)`` for all there is now; it must bear being called again for the same batch."""
    stream.writeStream.foreachBatch(apply).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
