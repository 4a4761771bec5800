"""Synchronisation of derived values: a feed of changes from a keyed comparison, applied as a merge, empty when asked again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changes(rows: DataFrame, source: DataFrame, by: list[str], column: str, value: str) -> DataFrame:
    """``by``, old and new of rows whose ``column`` is not what ``source`` (by, value), a key each, has; nulls compare too."""
    new = source.select(*by, F.col(value).alias("new"))
    return rows.join(new, by).where(~F.col(column).eqNullSafe(F.col("new"))).select(*by, F.col(column).alias("old"), "new")


def applied(rows: DataFrame, source: DataFrame, by: list[str], column: str, value: str) -> DataFrame:
    """``rows`` with ``column`` as ``source`` has it; rows that it lacks stay as they are."""
    new = source.select(*by, F.col(value).alias("__new"), F.lit(True).alias("__known"))
    out = rows.join(new, by, "left")
    return out.withColumn(column, F.when(F.col("__known"), F.col("__new")).otherwise(F.col(column))).select(*rows.columns)


def recounted(rows: DataFrame, children: DataFrame, by: list[str], column: str) -> DataFrame:
    """``rows`` with ``column`` as the number of their children, 0 without any."""
    n = children.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    return rows.join(n, by, "left").withColumn(column, F.coalesce("__n", F.lit(0)).cast(dict(rows.dtypes)[column])).select(*rows.columns)


def miscounted(rows: DataFrame, children: DataFrame, by: list[str], column: str) -> DataFrame:
    """Rows whose ``column`` is not the number of their children."""
    n = children.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    return rows.join(n, by, "left").where(~F.col(column).eqNullSafe(F.coalesce("__n", F.lit(0)).cast(dict(rows.dtypes)[column]))).select(*rows.columns)


def catalogue_names(definitions: DataFrame, names: DataFrame, note: str) -> DataFrame:
    """``definitions`` (code, group_code, ...) with name_local by ``names`` (code, name), name_en (the code's last part) and description.

    A code that ``names`` lacks keeps its last part as name_local too; untranslated() finds such.
    """
    last = F.substring_index("code", ".", -1)
    named = definitions.drop("name_local", "name_en", "description").join(names.select("code", F.col("name").alias("__name")), "code", "left")
    named = named.join(names.select(F.col("code").alias("group_code"), F.col("name").alias("__group")), "group_code", "left")
    group = F.coalesce("__group", "group_code")
    return named.select("code", "group_code", *[c for c in definitions.columns if c not in ("code", "group_code", "name_local", "name_en", "description")], F.coalesce("__name", last).alias("name_local"), last.alias("name_en"), F.concat(group, F.lit(note)).alias("description"))


def untranslated(definitions: DataFrame) -> DataFrame:
    """Definitions whose local name is plain letters, figures and marks."""
    return definitions.where(F.col("name_local").rlike(r"\A[A-Za-z0-9_ ./-]+\z"))


def renamed_paths(facts: DataFrame, old: str, new: str, links: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Facts with the path ``old`` under ``new``, and the links (by, path) that are then missing and have to be added."""
    out = facts.withColumn("path", F.when(F.col("path") == old, F.lit(new)).otherwise(F.col("path")))
    moved = out.where(F.col("path") == new).select(*by, "path").distinct()
    return out, moved.join(links.select(*by, "path"), [*by, "path"], "left_anti")
