"""Run queries beside their SQL and compare whole results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    if hasattr(value, "item"):
        return cell(value.item())
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False, name=None))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """First difference between two results, None when they are equal."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    kinds = {
        c: (spark_frame[c].dtype.kind, sql_frame[c].dtype.kind)
        for c in spark_frame.columns
        if spark_frame[c].dtype != sql_frame[c].dtype
    }
    a, b = rows(spark_frame), rows(sql_frame)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(spark_frame.columns)}\n{x}\n{y} (types {kinds})"
    odd = {c: k for c, k in kinds.items() if k[0] != k[1]}
    return f"types {odd}" if odd else None
