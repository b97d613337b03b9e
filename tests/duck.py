"""Comparison of registered queries with DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns by name, in a fixed order, exact for all values."""
    columns = sorted(frame.columns)
    values = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(values.itertuples(index=False, name=None), key=repr)


def differences(ours: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and a DuckDB one; None if nothing."""
    left, right = ours.toPandas(), con.execute(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} and {sorted(right.columns)}"
    a, b = rows(_plain(left)), rows(_plain(right))
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Dates, timestamps and numbers in one notation for both engines."""
    def plain(value):
        if value is None or value is pd.NaT or value != value:
            return None
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        if isinstance(value, bool) or isinstance(value, str):
            return value
        return float(value)

    return frame.apply(lambda column: column.map(plain).astype(object))
