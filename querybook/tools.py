"""Small helpers of the query definitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(queries: dict, sqls: dict, sql: str | None = None):
    """Decorator: enter a query under its function name, with its SQL if it has one."""

    def enter(fn: Query) -> Query:
        queries[fn.__name__] = fn
        if sql is not None:
            sqls[fn.__name__] = sql
        return fn

    return enter


def day(c: str) -> Column:
    return F.to_date(F.col(c))


def iso(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def six(c: Column | str) -> Column:
    return F.round(c, 6)


def newest(df: DataFrame, c: str) -> Column:
    """Largest value of a column as a scalar subquery."""
    return df.agg(F.max(c)).scalar()
