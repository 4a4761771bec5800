"""Nested JSON values of any depth as rows of leaves, and back.

A leaf is what is no object and, if lists are opened, no list, or an empty one of either. Its ``path`` has a step for each
level: {key} within an object, {pos} within a list. leaves() opens AT_ONCE levels of all values in one pass, until nothing is
left to open; what is still open is written between passes, so the plan does not grow with the depth. nested() puts values
together again from the deepest level up, by a grouped sum a level. assigned() and nested() deal rows over as many tasks as
there are PER_TASK of them, so that a task's memory does not grow with the table: paths compress so well that the size of a
shuffle says little about it.

Object keys come in their byte order. Numbers keep their value. A text that is no JSON, or null, has no leaves; a value that is
itself a leaf has the empty path. Columns ``by`` name a value; two rows alike in them are two values to leaves(), but
nested() takes them for one, so they must be a key there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = "struct<key:string,pos:int>"
AT_ONCE = 4
PER_TASK = 250_000


def leaves(df: DataFrame, by: list[str], text: str, keep, lists: bool = True) -> DataFrame:
    """``by``, path, json (the leaf as JSON) and kind (the leaf's type) of all leaves of the JSON in column ``text``."""
    open_ = lambda k: (k.startswith("OBJECT<") & (k != "OBJECT<>")) | (F.lit(lists) & k.startswith("ARRAY<") & (k != "ARRAY<>") & (F.col("json") != "[]"))
    rows, done = df.select(*by, F.array().cast(f"array<{STEP}>").alias("path"), F.try_parse_json(text).alias("v")), None
    while True:
        for _ in range(AT_ONCE):
            rows = _opened(rows, by, lists)
        # a value without JSON is left out when it is read again, so that nothing is parsed twice to find it
        rows = keep(rows.select(*by, "path", F.to_json("v").alias("json"), F.schema_of_variant("v").alias("kind"))).where("json is not null")
        shut, inside = rows.where(~open_(F.col("kind"))), rows.where(open_(F.col("kind")))
        done = shut if done is None else done.unionByName(shut)
        if inside.isEmpty():
            return done
        rows = inside.select(*by, "path", F.parse_json("json").alias("v"))


def _opened(rows: DataFrame, by: list[str], lists: bool) -> DataFrame:
    """``by``, path and v one level further in; a leaf stays as it is, and so does a list unless ``lists``."""
    x = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("v").outer()).alias("x"))
    inside = F.col("x.pos").isNotNull() & (F.lit(lists) | F.col("x.key").isNotNull())
    if not lists:  # of a list's items the first stands for the list
        x = x.where("x.pos is null or x.key is not null or x.pos = 0")
    step = F.struct(F.col("x.key").alias("key"), F.when(F.col("x.key").isNull(), F.col("x.pos")).cast("int").alias("pos")).cast(STEP)
    return x.select(*by, F.when(inside, F.array_append("path", step)).otherwise(F.col("path")).alias("path"), F.when(inside, F.col("x.value")).otherwise(F.col("v")).alias("v"))


def dotted(path: Column | str) -> Column:
    """Steps as text: keys and places between dots."""
    return F.array_join(F.transform(path, lambda s: F.coalesce(s["key"], s["pos"].cast("string"))), ".")


def is_number(kind: Column | str) -> Column:
    kind = F.col(kind) if isinstance(kind, str) else kind
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def numeric_leaves(df: DataFrame, by: list[str], text: str, keep) -> DataFrame:
    """``by``, path (keys between dots) and value of all numbers within objects; lists, texts and booleans are none.

    Rows with a value that is a number itself have the path "".
    """
    found = leaves(df, by, text, keep, lists=False).where(is_number("kind"))
    return found.select(*by, dotted("path").alias("path"), F.col("json").cast("double").alias("value"))


def nested(rows: DataFrame, by: list[str], keep) -> DataFrame:
    """``by`` and json: the values that the leaves ``rows`` (by, path, json) make up."""
    rows = keep(rows.select(*by, "path", "json"))
    tasks = {r["depth"]: r["n"] for r in rows.groupBy(F.size("path").alias("depth")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a level
    step, depth, made = F.element_at("path", -1), F.size("path"), None
    for level in range(max(tasks, default=0), 0, -1):
        last = F.struct(step["key"].alias("key"), step["pos"].alias("pos"), F.col("json"))
        here = rows.where(depth == level)
        here = here if made is None else here.unionByName(made)
        n = tasks.get(level, 0) + (0 if made is None else made.count())
        here = _dealt(here.select(*by, F.slice("path", 1, level - 1).alias("path"), last.alias("x")), n, *by, "path")
        groups = here.groupBy(*by, "path").agg(F.sort_array(F.collect_list("x")).alias("xs"))
        named = lambda x: F.concat(_quoted(x["key"]), F.lit(":"), x["json"])
        inner = F.when(F.col("xs")[0]["key"].isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform("xs", named), ","), F.lit("}")))
        whole = F.coalesce(inner, F.concat(F.lit("["), F.array_join(F.transform("xs", lambda x: x["json"]), ","), F.lit("]")))
        made = keep(groups.select(*by, "path", whole.alias("json")))
    whole = rows.where(depth == 0)
    return (whole if made is None else whole.unionByName(made)).select(*by, "json")


def _dealt(rows: DataFrame, n: int, *keys) -> DataFrame:
    """``n`` rows over tasks of PER_TASK."""
    return rows.repartition(max(1, -(-n // PER_TASK)), *keys)


def _quoted(key: Column) -> Column:
    """A key as a JSON string."""
    pair = F.to_json(F.struct(key.alias("k")))  # {"k":"..."}
    return F.substring(pair, F.lit(6), F.length(pair) - 6)


def assigned(rows: DataFrame, changes: DataFrame, by: list[str], roots: list[str] | None = None) -> DataFrame:
    """Leaves with those of ``changes`` (by, path, json) in place of theirs, or added where the path is new.

    A path must begin with one of ``roots``, if given, else it is an error. Leaves under a path that is assigned go.
    """
    new = changes.select(*by, "path", "json")
    if roots is not None:
        unknown = F.raise_error(F.concat(F.lit("unknown path "), dotted("path")))
        new = new.withColumn("json", F.when(F.coalesce(F.get("path", F.lit(0))["key"].isin(*roots), F.lit(False)), F.col("json")).otherwise(unknown.cast("string")))
    left, n = rows.select(*by, "path", "json"), rows.count()
    for (depth,) in new.select(F.size("path").alias("n")).distinct().orderBy("n").collect():  # a row a level
        heads = new.where(F.size("path") == depth).select(*by, F.col("path").alias("head"))
        dealt = [_dealt(x, n, *by, "head") for x in (left.withColumn("head", F.slice("path", 1, depth)), heads)]  # alike, so neither is dealt again
        left = dealt[0].join(dealt[1], [*by, "head"], "left_anti").drop("head")
    return left.select(*by, "path", "json").unionByName(new)


def cleared(rows: DataFrame, roots: list[str]) -> DataFrame:
    """Leaves whose numbers under ``roots`` are null; texts, booleans and other roots stay."""
    hit = is_number("kind") & F.coalesce(F.get("path", F.lit(0))["key"].isin(*roots), F.lit(False))
    return rows.withColumns({"json": F.when(hit, "null").otherwise(F.col("json")), "kind": F.when(hit, "VOID").otherwise(F.col("kind"))})
