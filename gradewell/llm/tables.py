"""Helpers shared by the operators: loading, keys for rows, pinned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewell.session import pin

__all__ = ["LAST", "load", "pin", "row_id", "text_key"]

LAST = 2**63 - 1


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def row_id(c: str = "doc_id") -> Column:
    """The id as a non-null key; rows without an id come last."""
    return F.coalesce(F.col(c).cast("long"), F.lit(LAST))


def text_key(c: str = "text") -> Column:
    """Tells apart rows that repeat an id with another text."""
    return F.xxhash64(F.coalesce(F.col(c), F.lit("")))
