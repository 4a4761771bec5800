"""Column functions: keys, text, scores. All are built-in expressions but nfkc_casefold and nfkc_casefold_all."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stable_id(namespace: str, key: Column, prefix: str = "ambrel") -> Column:
    """63 bits of SHA-256 of "prefix:namespace:key", as a bigint."""
    digest = F.substring(F.sha2(F.concat(F.lit(f"{prefix}:{namespace}:"), key.cast("string")), 256), 1, 16)
    return (F.conv(digest, 16, 10).cast("decimal(20,0)") % F.lit("9223372036854775808").cast("decimal(20,0)")).cast("bigint")


@F.pandas_udf(T.StringType())
def nfkc_casefold(text: pd.Series) -> pd.Series:
    """Unicode NFKC, stripped, case-folded; Spark has no built-in for it."""
    import unicodedata

    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).strip().casefold())


@F.pandas_udf(T.ArrayType(T.StringType()))
def nfkc_casefold_all(texts: pd.Series) -> pd.Series:
    """The same of every text of an array."""
    import unicodedata

    fold = lambda t: None if t is None else unicodedata.normalize("NFKC", t).strip().casefold()
    return texts.map(lambda ts: None if ts is None else [fold(t) for t in ts])


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def l1_similarity(a: Column, b: Column) -> Column:
    """1 - mean absolute difference of two arrays, within [0, 1]."""
    total = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)
    return clamp(1 - total / F.size(a))


def hash_unit(seed: str, key: Column) -> Column:
    """A number in [0, 1] from 32 bits of SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(seed), key.cast("string")), 256), 1, 8), 16, 10).cast("bigint") / F.lit(4294967295.0)


def logistic(x: Column, low: float = 0.0, height: float = 1.0) -> Column:
    return low + height / (1 + F.exp(-x))


def sentences(text: Column, enders: str = "[.!?]", least: int = 10) -> Column:
    """Trimmed stretches between sentence ends of at least ``least`` code points."""
    return F.filter(F.transform(F.split(text, enders), lambda s: F.trim(s)), lambda s: F.length(s) >= least)


def shift_suffix(code: Column, by: int, width: int = 3) -> Column:
    """Add to the number after the last underscore, zero-padded; null where it no longer fits."""
    n = F.regexp_extract(code, r"(\d+)$", 1).cast("int") + by
    head = F.regexp_replace(code, r"\d+$", "")
    return F.when(n < 10**width, F.concat(head, F.lpad(n.cast("string"), width, "0")))


def repair_json(text: Column) -> Column:
    """Text with code fences, a byte-order mark and trailing commas taken away."""
    bare = F.regexp_replace(F.trim(text), r"^﻿|^```[A-Za-z]*\s*|\s*```$", "")
    return F.regexp_replace(bare, r",\s*([}\]])", "$1")


def labelled_lines(pairs: list[tuple[str, Column]], mark: str = ": ") -> Column:
    """"label: value" lines of the values that are there."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(k + mark), v)) for k, v in pairs])), "\n")


def sql_quote(text: Column) -> Column:
    return F.concat(F.lit("'"), F.regexp_replace(text, "'", "''"), F.lit("'"))
