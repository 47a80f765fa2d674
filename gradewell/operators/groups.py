"""Group aggregates, and group values attached to every row.

Aggregates run with map-side partial aggregation, so a hot group arrives at its
reducer as one row per map task. Attaching is one aggregate, written down with each
group's number of rows, and one join: the same table gives the values and tells which
groups are hot, so the input is read twice in all. A window would bring every row of a
group to one task, and sorting the rows into segments would shuffle all of them where
a join with few groups shuffles none.
Rows without a key form no group and get no value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.operators.columns import quoted
from gradewell.operators.filters import require
from gradewell.operators.joins import lookup_join
from gradewell.operators.spread import Chain, counted_directory
from gradewell.session import pin


def group_stats(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    return (
        require(df, keys)
        .groupBy(*[quoted(k) for k in keys])
        .agg(*[c.alias(name) for name, c in aggs.items()])
    )


def group_mean(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    return group_stats(df, keys, {name: F.avg(quoted(col))})


def group_count(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    return group_stats(df, keys, {name: F.count(quoted(col))})


def sized_stats(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Aggregates and ``__rows`` of each group, rows without a key as groups of their own; pinned."""
    columns = [c.alias(name) for name, c in aggs.items()]
    return pin(df.groupBy(*[quoted(k) for k in keys]).agg(*columns, F.count(F.lit(1)).alias("__rows")))


def attach(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, Column],
    source: DataFrame | None = None,
) -> DataFrame:
    """Every row with its group's aggregates.

    ``source`` is a cheaper table with the same groups to aggregate and count on,
    for use in chains; without it ``df`` is read again.
    """
    stats = sized_stats(df if source is None else source, keys, aggs)
    hot = counted_directory(stats, keys, "__rows")
    return lookup_join(df, require(stats, keys).drop("__rows"), keys, "left", hot)


def attach_sums(
    df: DataFrame, levels: Mapping[str, Sequence[str]], value: Column | str
) -> DataFrame:
    """Every row with the sum of ``value`` over each level's group: ``{new column: keys}``.

    The rows are summed once, by all keys together; every level's sums and group sizes
    come from those partial sums.
    """
    finest = list(dict.fromkeys(k for keys in levels.values() for k in keys))
    sums = sized_stats(df, finest, {"__sum": total(value)})
    hot, sides = {}, []
    for name, keys in levels.items():
        level = sums.groupBy(*[quoted(k) for k in keys]).agg(
            F.sum("__sum").alias(name), F.sum("__rows").alias("__rows")
        )
        hot |= counted_directory(level, keys, "__rows")
        sides.append((require(level, keys).drop("__rows"), keys))
    chain = Chain(df, hot=hot)
    for side, keys in sides:
        chain.join(side, keys)
    return chain.done()


def total(col: Column | str) -> Column:
    """Sum that is 0, not NULL, for a group without values."""
    c = quoted(col) if isinstance(col, str) else col
    return F.coalesce(F.sum(c), F.lit(0))


def share(flag: str, weight: str | None = None) -> Column:
    """Share of rows with the 0/1 flag set; a NULL flag is not set. A row counts as often as its ``weight`` says."""
    if weight:
        return F.try_divide(total(quoted(flag) * quoted(weight)), F.sum(quoted(weight)))
    return F.try_divide(total(flag), F.count(F.lit(1)))


def attach_rate(df: DataFrame, keys: Sequence[str], flags: Mapping[str, str]) -> DataFrame:
    """Share of each 0/1 flag within the group's rows, on every row."""
    return attach(df, keys, {name: share(flag) for name, flag in flags.items()})


def category_counts(
    df: DataFrame, keys: Sequence[str], col: str, lists: Mapping[str, Sequence]
) -> DataFrame:
    """One row per key with the number of rows in each list, in one pass."""
    return group_stats(
        df, keys, {name: F.count_if(quoted(col).isin(list(v))) for name, v in lists.items()}
    )


def flag_totals(
    df: DataFrame, keys: Sequence[str], tests: Mapping[str, Column], rows: str
) -> DataFrame:
    """Row count and number of rows that pass each test, per key."""
    return group_stats(
        df, keys, {rows: F.count(F.lit(1)), **{name: F.count_if(t) for name, t in tests.items()}}
    )


def rollup_counts(df: DataFrame, keys: Sequence[str], count: str = "count") -> DataFrame:
    """Counts of a finer grouping summed to ``keys``; NULL keys are a group here."""
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.sum(quoted(count)).alias(count))
