"""Relational operators over DataFrames. Snapshots stand in for MERGE, which parquet tables do not have."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def upsert(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """New rows are added whole; where the key is there, the listed columns are assigned, nulls too."""
    n = new.select(F.col(key).alias("__k"), F.struct(*new.columns).alias("__n"))
    joined = old.join(n, F.col(key) == F.col("__k"), "full_outer")
    pick = lambda c: F.when(F.col(key).isNull() | (F.col("__k").isNotNull() & F.lit(c in columns)), F.col(f"__n.{c}")).otherwise(F.col(c))
    return joined.select(*[pick(c).alias(c) for c in old.columns])


def replace_children(old: DataFrame, new: DataFrame, parent: str, parents: DataFrame) -> DataFrame:
    """All children of ``parents`` go, and ``new`` come."""
    return old.join(parents.select(parent).distinct(), parent, "left_anti").unionByName(new)


def restore(current: DataFrame, touched: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Roll back: rows with touched keys go, their before-image comes."""
    return current.join(touched.select(key).distinct(), key, "left_anti").unionByName(before)


def latest(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group."""
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where("__r = 1").drop("__r")


def versions(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """Rows as versions of their group: version from 1 and is_current for the last."""
    w = W.partitionBy(*by)
    return df.withColumn("version", F.row_number().over(w.orderBy(*order))).withColumn("is_current", (F.col("version") == F.count(F.lit(1)).over(w)).cast("int"))


def pivot_max(df: DataFrame, by: str, key: str, value: str, names: list[str], default: float | None = None) -> DataFrame:
    """One row a group with a column for each name."""
    cell = lambda n: F.max(F.when(F.col(key) == n, F.col(value)))
    return df.groupBy(by).agg(*[(F.coalesce(cell(n), F.lit(default)) if default is not None else cell(n)).alias(n) for n in names])


def append_ordinals(old: DataFrame, new: DataFrame, by: str, ordinal: str, order: list[Column]) -> DataFrame:
    """``new`` with ordinals that go on from the group's greatest."""
    top = old.groupBy(by).agg(F.max(ordinal).alias("__top"))
    return new.join(top, by, "left").withColumn(ordinal, (F.coalesce("__top", F.lit(0)) + F.row_number().over(W.partitionBy(by).orderBy(*order))).cast("long")).drop("__top")


def match_counts(refs: DataFrame, targets: DataFrame, ref: str, names: list[str], target_id: str) -> DataFrame:
    """How many targets a reference matches by any of several columns: equality joins, united, never an OR condition."""
    hits = reduce(DataFrame.union, [refs.join(targets.select(F.col(n).alias(ref), target_id), ref).select(ref, target_id) for n in names])
    counts = hits.groupBy(ref).agg(F.countDistinct(target_id).alias("n"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return refs.join(counts, ref, "left").select(ref, n.alias("matches"), F.when(n == 0, "none").when(n == 1, "one").otherwise("many").alias("verdict"))


def set_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows only on either side, counted in one pass: left_only, right_only and both."""
    marked = left.withColumn("__s", F.lit(1)).union(right.withColumn("__s", F.lit(2)))
    sides = marked.groupBy(*left.columns).agg(F.bit_or("__s").alias("__s"))
    n = lambda v: F.count_if(F.col("__s") == v)
    return sides.agg(n(1).alias("left_only"), n(2).alias("right_only"), n(3).alias("both"))


def nest(parents: DataFrame, children: DataFrame, key: str, child_key: str, item: Column, order: Column, name: str) -> DataFrame:
    """Each parent with its children's items in order, an empty list when there are none."""
    lists = children.groupBy(F.col(child_key).alias(key)).agg(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), item.alias("i")))), lambda x: x["i"]).alias(name))
    return parents.join(lists, key, "left").withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def ordered_distinct(df: DataFrame, by: str, value: str, position: list[Column]) -> DataFrame:
    """Each distinct value of a group in the order of its first appearance, from 0."""
    numbered = df.withColumn("__p", F.row_number().over(W.partitionBy(by).orderBy(*position)))
    first = numbered.groupBy(by, value).agg(F.min("__p").alias("__p"))
    return first.select(by, value, (F.row_number().over(W.partitionBy(by).orderBy("__p")) - 1).cast("long").alias("ordinal"))


def present(df: DataFrame) -> DataFrame:
    """Rows not marked deleted; a null mark is none."""
    return df.where(F.coalesce(F.col("deleted"), F.lit(0)) == 0)


def transitive_closure(edges: DataFrame, source: str, target: str, keep) -> DataFrame:
    """All (source, target) pairs with a path; ``keep`` cuts lineage between rounds."""
    step = edges.select(F.col(source).alias("s"), F.col(target).alias("t")).distinct()
    reached, n = keep(step), -1
    while (now := reached.count()) != n:
        n = now
        longer = reached.alias("a").join(step.alias("b"), F.col("a.t") == F.col("b.s")).select("a.s", "b.t")
        reached = keep(reached.union(longer).distinct())
    return reached


def remapped(df: DataFrame, mapping: DataFrame, key: str, name: str, strict: bool = False) -> DataFrame:
    """``df`` with ``name``, the key's new value by ``mapping`` (old, new), and state 'resolved' or 'pending'.

    A key that the mapping lacks keeps its value and is pending; ``strict`` makes it an error when the rows are computed.
    """
    known = mapping.select(F.col("old").alias("__old"), F.col("new").alias("__new"), F.lit(True).alias("__known"))
    out = df.join(known, F.col(key) == F.col("__old"), "left")
    found = F.coalesce("__known", F.lit(False))
    lost = F.raise_error(F.concat(F.lit(f"no new {key} for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("string") if strict else F.lit("pending")
    return out.select(*df.columns, F.when(found, F.col("__new")).otherwise(F.col(key)).alias(name), F.when(found, F.lit("resolved")).otherwise(lost).alias("state"))
