"""Choose rows per group.

``row_number() <= n`` is planned with a partial group limit: each map task sends
at most n rows per key, so a hot key brings at most n rows per map task to its
reducer. Orders are explicit and should end in a unique column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell.operators.columns import quoted
from gradewell.operators.filters import require
from gradewell.operators.groups import group_stats, sized_stats
from gradewell.operators.joins import lookup_join
from gradewell.operators.spread import counted_directory


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, number: str = "__rn"
) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, numbered from 1."""
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)
    return df.withColumn(number, F.row_number().over(window)).where(F.col(number) <= n)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per group; rows without a sort value come last, without a key not at all."""
    by = [quoted(c).asc_nulls_last() for c in order]
    return top_n_per_group(require(df, keys), keys, by).drop("__rn")


def last_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per group; a missing sort value never wins over a known one."""
    by = [quoted(c).desc_nulls_last() for c in order]
    return top_n_per_group(require(df, keys), keys, by).drop("__rn")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``; a missing key counts as one key."""
    by = [quoted(c).asc_nulls_last() for c in order]
    return top_n_per_group(df, keys, by).drop("__rn")


def rows_of_latest(df: DataFrame, key: str, day: str) -> DataFrame:
    """All rows of each key's latest day.

    One aggregate gives each key's latest day and its number of rows, so neither a
    hot key nor a day that many rows share gathers in one task, and the input
    is read once more than it would be anyway.
    """
    latest = sized_stats(require(df, [key]), [key], {"__latest": F.max(quoted(day))})
    hot = counted_directory(latest, [key], "__rows")
    joined = lookup_join(require(df, [key]), latest.drop("__rows"), [key], "inner", hot)
    return joined.where(quoted(day) == F.col("__latest")).drop("__latest")


def fanout_join(
    df: DataFrame, dim: DataFrame, lkey: str, rkey: str, order: Sequence[str]
) -> DataFrame:
    """Inner join with a dimension of several rows per key, one result row per left row.

    The dimension is cut to the first row per key before the join, which gives
    what joining first and deduplicating after would, without the fan-out.
    """
    one = first_per_group(dim, [rkey], order).withColumnRenamed(rkey, "__k")
    keyed = df.withColumn("__k", quoted(lkey))
    return lookup_join(keyed, one, ["__k"], "inner").withColumnRenamed("__k", rkey)


def attach_other(
    df: DataFrame, other: DataFrame, key: str, day: str, name: str
) -> DataFrame:
    """Left-join the number of ``other`` rows on that side's latest day per key."""
    per_day = other.groupBy(key, day).agg(F.count(F.lit(1)).alias("__c"))
    latest = group_stats(per_day, [key], {name: F.max_by("__c", day)})
    return lookup_join(df, latest, [key], "left")
