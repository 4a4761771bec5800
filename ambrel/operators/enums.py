"""Enumerations as several sources state them, compared code by code.

Sources are texts (program code with enums and a switch over them, documents with sections of listed codes) and tables with
columns of codes. Scanners turn each into rows (source, enum, code); faults() lines them up with the reference's own rows in
one grouped pass: a source that must agree lacks codes or has others, a source that may only use them has others. Texts are
whole; a section, enum or switch that is not there has no codes, so all of them are missing. Codes are text: "7", or "7:2" for
a pair.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "source string, enum string, code string"


def between(text: Column, start: str, end: str) -> Column:
    """From the first ``start`` to the next ``end`` behind it, both literal; null without either."""
    tail = F.when(F.contains(text, F.lit(start)), F.substr(text, F.locate(start, text)))
    rest = F.substr(tail, F.lit(len(start) + 1))
    return F.when(F.contains(rest, F.lit(end)), F.concat(F.lit(start), F.split_part(rest, F.lit(end), F.lit(1))))


def constants(text: Column, enum: str) -> Column:
    """(name, code, second) of the constants NAME(code, ...) of an enum; second is a number behind the code, if there is one."""
    block = F.coalesce(between(text, f"enum {enum}", "private final"), F.lit(""))
    pattern = F.lit(r"\b([A-Z][A-Z0-9_]*)\(\s*(\d+)\s*,\s*(\d+)?")
    part = lambda i: F.regexp_extract_all(block, pattern, F.lit(i))
    return F.transform(F.arrays_zip(part(1).alias("name"), part(2).alias("code"), part(3).alias("second")), lambda x: F.struct(x["name"].alias("name"), x["code"].alias("code"), F.nullif(x["second"], F.lit("")).alias("second")))


def cases(text: Column, start: str, variable: str) -> Column:
    """(name, values) of a switch's arms ``case A, B -> variable == 1 || variable == 2;``, one for each name; no values for ``true``: all."""
    block = F.coalesce(between(text, start, "};"), F.lit(""))
    pattern = F.lit(r"case\s+([A-Z0-9_, ]+?)\s*->\s*([^;]+);")
    arms = F.arrays_zip(F.regexp_extract_all(block, pattern, F.lit(1)).alias("names"), F.regexp_extract_all(block, pattern, F.lit(2)).alias("says"))
    values = lambda says: F.when(F.trim(says) != "true", F.regexp_extract_all(says, F.lit(rf"\b{variable}\s*==\s*(\d+)"), F.lit(1)))
    return F.flatten(F.transform(arms, lambda a: F.transform(F.split(a["names"], ","), lambda n: F.struct(F.trim(n).alias("name"), values(a["says"]).alias("values")))))


def listed(text: Column, start: str, end: str) -> Column:
    """Codes that a section lists, a line "- `code`" each."""
    return F.regexp_extract_all(F.coalesce(between(text, start, end), F.lit("")), F.lit(r"(?m)^- `([0-9]+)`"), F.lit(1))


def quoted(text: Column, least: int, most: int) -> Column:
    """All codes of ``least`` to ``most`` digits in backquotes."""
    return F.regexp_extract_all(text, F.lit(rf"`(\d{{{least},{most}}})`"), F.lit(1))


def rows(df: DataFrame, source: str, enum: str, codes: Column) -> DataFrame:
    """(source, enum, code) of a column with a list of codes."""
    return df.select(F.lit(source).alias("source"), F.lit(enum).alias("enum"), F.explode(codes.cast("array<string>")).alias("code")).where("code is not null").distinct()


def pairs(df: DataFrame, source: str, enum: str, constants_: Column, cases_: Column, every: DataFrame) -> DataFrame:
    """(source, enum, "code:value") of a switch's arms; an arm for all has those of ``every`` (value)."""
    names = df.select(F.explode(constants_).alias("x")).select("x.name", "x.code")
    arms = df.select(F.explode(cases_).alias("x")).select("x.name", "x.values")
    known = arms.join(names, "name")
    some = known.where("values is not null").select("code", F.explode("values").alias("value"))
    whole = known.where("values is null").select("code").join(F.broadcast(every.agg(F.collect_set(F.col("value").cast("string")).alias("all")))).select("code", F.explode("all").alias("value"))  # one row
    return some.union(whole).select(F.lit(source).alias("source"), F.lit(enum).alias("enum"), F.concat_ws(":", "code", "value").alias("code")).distinct()


def faults(expected: DataFrame, found: list[DataFrame], equal: list[str], within: list[str] = ()) -> DataFrame:
    """(enum, code, source, fault) of all differences from ``expected`` (enum, code).

    Sources in ``equal`` are asked for every enum that they state or, as "source/enum", that they must state; those in
    ``within`` for codes that are not expected alone.
    """
    stated = reduce(DataFrame.union, found)
    must = [x.split("/") for x in equal]
    asked = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(e).alias("enum")) for s, e in must])
    wanted = expected.select("enum", "code", F.explode(F.filter(asked, lambda a: a["enum"] == F.col("enum"))["source"]).alias("source")).select("source", "enum", "code")
    sides = wanted.withColumn("side", F.lit(1)).union(stated.withColumn("side", F.lit(2))).groupBy("source", "enum", "code").agg(F.sum("side").alias("side"))
    known = expected.select("enum", "code").distinct().withColumn("known", F.lit(True))
    judged = sides.join(known, ["enum", "code"], "left")
    fault = F.when(F.col("side") == 1, "missing").when(F.col("known").isNull(), "unknown")
    sources = {s for s, _ in must} | set(within)
    return judged.where(F.col("source").isin(*sources)).select("enum", "code", "source", fault.alias("fault")).where("fault is not null")
