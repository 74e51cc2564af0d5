"""Run a query and its SQL side by side and compare schema, rows and values."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
         "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """Differences, empty when both agree."""
    left = query(spark, sf_dir)
    right = con.sql(sql)
    mine = {f.name: f.dataType.simpleString() for f in left.schema}
    theirs = {c: KINDS.get(str(t), str(t)) for c, t in zip(right.columns, right.types)}
    if mine != theirs:
        return [f"schema {mine} but SQL gives {theirs}"]
    columns = sorted(mine)
    got, want = (
        _ordered(df[columns]) for df in (left.toPandas(), right.df())
    )
    if len(got) != len(want):
        return [f"{len(got)} rows but SQL gives {len(want)}"]
    return [] if got.equals(want) else [f"values differ: {got.compare(want).head()}"]


def _ordered(df: pd.DataFrame) -> pd.DataFrame:
    plain = df.sort_values(list(df.columns)).reset_index(drop=True).astype(object)
    return plain.where(plain.notna(), None)
