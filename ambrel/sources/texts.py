"""Sources made of loose text: JSON arrays, lists of names, answers of language models that are nearly JSON.

Whole files are one row each; what the built-in functions can parse stays in them, and the repair ladders run as
Pandas UDFs that give a value or an error, never an exception.
"""

from __future__ import annotations

import ast
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())
OUTCOME = T.StructType([T.StructField("value", T.StringType()), T.StructField("error", T.StringType())])
FENCE = re.compile(r"\A\s*```[A-Za-z]*\s*|\s*```\s*\Z")


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """path and text of each file, a byte-order mark taken away."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    return files.withColumn("text", F.regexp_replace("text", "\\A\ufeff", ""))


def json_items(spark: SparkSession, path: str, schema: str, member: str | None = None) -> DataFrame:
    """The objects of each file's top-level array (or of the array in ``member`` of a top-level object).

    Columns are those of ``schema`` after path and position. A file of another shape raises; an item that is no
    object has nulls in all columns, for the contract to report.
    """
    v = F.try_parse_json("text")
    if member:
        v = F.coalesce(F.variant_get(v, f"$.{member}", "variant"), v)
    files = whole_texts(spark, path).withColumn("v", v)
    wrong = F.col("v").isNull() | ~F.coalesce(F.schema_of_variant("v").startswith("ARRAY"), F.lit(False))
    array = F.when(wrong, F.raise_error(F.concat(F.lit("no JSON array in "), "path"))).otherwise(F.col("v").cast("array<variant>"))
    items = files.select("path", F.posexplode(array).alias("position", "item"))
    return items.select("path", F.col("position").cast("long").alias("position"), F.from_json(F.to_json("item"), schema).alias("d")).select("path", "position", "d.*")


def listed_lines(spark: SparkSession, path: str) -> DataFrame:
    """position and item: trimmed lines that are neither blank nor comments, each once at its first place."""
    lines = whole_texts(spark, path).select("path", F.posexplode(F.split("text", "\r?\n")).alias("line", "item")).withColumn("item", F.regexp_replace("item", r"(?U)^\s+|\s+$", ""))
    first = lines.where("item <> '' and not startswith(item, '#')").groupBy("item").agg(F.min(F.struct("path", "line")).alias("at"))
    return first.select(F.col("at.path").alias("path"), F.col("at.line").cast("long").alias("position"), "item")


def quoted_names(text: Column) -> Column:
    """Everything between double quotes, in order."""
    return F.regexp_extract_all(text, F.lit('"([^"]+)"'), F.lit(1))


def close_array(text: Column) -> Column:
    """An array that breaks off after an item gets its end."""
    bare = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.when(bare.startswith("[") & bare.endswith("},"), F.concat(F.substring(bare, F.lit(1), F.length(bare) - 1), F.lit("]"))).otherwise(bare)


def by_priority(frames: list[DataFrame], key: str, position: str) -> DataFrame:
    """Rows of several sources: of each key the first row of the first source that has it."""
    ranked = [f.withColumn("__source", F.lit(i)) for i, f in enumerate(frames)]
    all_rows = ranked[0]
    for f in ranked[1:]:
        all_rows = all_rows.unionByName(f, allowMissingColumns=True)
    n = F.row_number().over(W.partitionBy(key).orderBy("__source", F.asc_nulls_last(position)))
    return all_rows.where(F.col(key).isNotNull()).withColumn("__n", n).where("__n = 1").drop("__n", "__source")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def _names(text: str) -> list[str]:
    for parse in (json.loads, ast.literal_eval):
        try:
            value = parse(text)
        except (ValueError, SyntaxError, RecursionError, MemoryError, TypeError):
            continue
        if isinstance(value, (list, tuple, set)):
            return [str(v).strip() for v in value if v is not None and str(v).strip()]
    return re.findall(r'"([^"]+)"', text) or [t for line in text.splitlines() if (t := line.strip().rstrip(",").strip()) and not t.startswith("#")]


@F.pandas_udf(STRINGS)
def names_of(text: pd.Series) -> pd.Series:
    """Names of a list in JSON, in Python, between quotes, or one a line: the first form that fits."""
    return text.map(lambda t: [] if t is None else _names(t))


def _first_value(text: str):
    """The first array or object of a text, which must be its end; (value, None) or (None, error)."""
    bare, decoder, at = FENCE.sub("", text).strip(), json.JSONDecoder(), 0
    while (found := re.compile(r"[\[{]").search(bare, at)) is not None:
        try:
            value, end = decoder.raw_decode(bare, found.start())
        except (ValueError, RecursionError):
            at = found.end()
            continue
        return (None, "text after the JSON value") if bare[end:].strip() else (value, None)
    return None, "no JSON value"


def _quotes_escaped(text: str) -> str:
    """Quotes inside the value of a line ``"key": "value",`` escaped."""

    def mend(m):
        inner = re.sub(r'(?<!\\)"', r'\\"', m["value"])
        return f"{m['head']}{inner}{m['tail']}"

    return re.sub(r'^(?P<head>\s*(?:"[^"\n]*"\s*:\s*)?")(?P<value>.*)(?P<tail>"\s*[,}\]]*\s*)$', mend, text, flags=re.M)


def _balanced(text: str) -> str:
    """Brackets left open at the end closed, strings seen as strings."""
    open_, inside, escaped = [], False, False
    for c in text:
        if inside:
            inside, escaped = escaped or c != '"', not escaped and c == "\\"
        elif c == '"':
            inside = True
        elif c in "[{":
            open_.append("]" if c == "[" else "}")
        elif c in "]}" and open_:
            open_.pop()
    return text + "".join(reversed(open_))


def _repaired(text: str):
    bare = FENCE.sub("", text.lstrip("\ufeff")).strip()
    commas = lambda t: re.sub(r",(\s*[}\]])", r"\1", t)
    steps = [lambda t: t, commas, lambda t: _quotes_escaped(commas(t)), lambda t: commas(_balanced(t)), lambda t: commas(_balanced(_quotes_escaped(t)))]
    error = None
    for step in steps:
        try:
            return json.loads(step(bare)), None
        except (ValueError, RecursionError) as e:
            error = error or str(e)
    return None, error


def _partial(text: str) -> list[str]:
    """The complete objects at the top of an array that may break off."""
    bare, decoder, out = FENCE.sub("", text), json.JSONDecoder(), []
    at = bare.find("[") + 1
    while at and (m := re.compile(r"[\s,]*(?=\{)").match(bare, at)):
        try:
            value, at = decoder.raw_decode(bare, m.end())
        except (ValueError, RecursionError):
            break
        out.append(json.dumps(value, ensure_ascii=False))
    return out


def _outcome(parse):
    def run(text: pd.Series) -> pd.DataFrame:
        found = [(None, "no text") if t is None else parse(t) for t in text]
        return pd.DataFrame([(None if e else json.dumps(v, ensure_ascii=False), e) for v, e in found], columns=["value", "error"], dtype=object)

    return F.pandas_udf(run, OUTCOME)


#: text -> struct of value (JSON) and error: the only value of a text, which may stand after other words.
embedded_json = _outcome(_first_value)
#: text -> struct of value (JSON) and error, after repairs from the mildest: fences, commas, inner quotes, open brackets.
repaired_json = _outcome(_repaired)


@F.pandas_udf(STRINGS)
def complete_objects(text: pd.Series) -> pd.Series:
    """Every complete object of an array that breaks off."""
    return text.map(lambda t: [] if t is None else _partial(t))
