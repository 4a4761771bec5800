"""Compare a query with its SQL in DuckDB, rows in any order."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = os.environ.get("AMBREL_TESTDATA", "/root/testdata")


def connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def rows(frame) -> list[tuple]:
    cols = sorted(frame.columns)
    clean = lambda v: None if v is None or v is pd.NA or v != v else round(float(v), 6) if isinstance(v, float) else v.item() if hasattr(v, "item") else v
    return sorted((tuple(map(clean, r)) for r in frame[cols].astype(object).itertuples(index=False)), key=repr)


def differences(spark, sf_dir: str, run, sql: str) -> str:
    got, expected = run(spark, sf_dir).toPandas(), connection(sf_dir).execute(sql).df()
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} and {sorted(expected.columns)}"
    a, b = rows(got), rows(expected)
    return "" if a == b else f"{len(a)} and {len(b)} rows; first difference {next((x for x in zip(a, b) if x[0] != x[1]), None)}"
