"""Order-based group operators: percent rank, median, lag.

Rank and median read one order-statistic index: each distinct (group, measure, value)
with its number of rows, the rows of the group below it and the rows of the group. The
index is cut into sorted segments: a range partitioning by (group, measure, value) whose
partition number is written down once (``pin``). Running counts are made inside a
segment; what crosses a border is the one group that lies on it, so at most two rows per
segment are carried over. Values keep their own type, so numbers beyond
a double's precision, decimals, dates and texts rank as exactly as doubles do. Ties
are one row of the index, however many rows share the value.

Lag cuts the rows themselves into sorted segments and exchanges their edges.

Segments are as many as the session's shuffle partitions. An index of few values, measured
once it is written, becomes one short list for each group and measure, which goes to
the rows that look their ranks up (percentages and other small scales do); of any other
index and its rows both are shuffled. A ``weight`` column says how many equal rows one stands for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewell.operators.columns import all_present, quoted, select_cols
from gradewell.operators.groups import group_stats
from gradewell.operators.joins import lookup_join
from gradewell.operators.spread import Chain, counted_directory, tasks
from gradewell.session import pin

# Session settings and their defaults: the most rows of an index that is sent to every task,
# and the most values of a group and measure in it, as a row looks through its list.
LISTED_ROWS = ("spark.gradewell.maxListedRows", 1_000_000)
LISTED_VALUES = ("spark.gradewell.maxListedValues", 256)


def attach_pct_rank(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    rounded: bool = True,
    min_size: tuple[str, int] | None = None,
) -> DataFrame:
    """Percent ranks ``{new column: measure}`` within the group, on every row.

    The average rank of ties over the number of known values, times 100. A row
    without a value or without a group has no rank. ``rounded`` rounds half to even.
    ``min_size`` = (size column, least size) leaves the rank NULL in smaller groups.
    For many measures of a table with a row key see ``rank_rows``.
    """
    gate = quoted(min_size[0]) >= min_size[1] if min_size else F.lit(True)
    names = list(dict.fromkeys(measures.values()))
    entries = [Entry(keys, m, all_present(keys)) for m in names]
    places = value_columns(df, names)
    index = pin(order_index(long_values(df.where(gate), entries), group_columns(entries), value_names(df, entries)))
    wanted = df.withColumns({f"__m{i}": F.when(gate, quoted(m)) for i, m in enumerate(names)})
    chain = Chain(wanted, *[[*keys, f"__m{i}"] for i in range(len(names))])
    for i, m in enumerate(names):
        mine = index.where(F.col("__measure") == i).select(
            *[quoted(k) for k in keys], F.col(places[m]).alias(f"__m{i}"), percent().alias(f"__p{i}")
        )
        chain.join(mine, [*keys, f"__m{i}"])
    ranked = {
        new: F.bround(f"__p{names.index(m)}", 0) if rounded else F.col(f"__p{names.index(m)}")
        for new, m in measures.items()
    }
    out = chain.done().withColumns(ranked)
    return out.select(*[quoted(c) for c in dict.fromkeys([*df.columns, *measures])])


@dataclass(frozen=True)
class Ranking:
    """Ranks ``{new column: measure}`` within ``keys``, in groups of ``min_size`` = (size column, least size)."""

    keys: Sequence[str]
    measures: Mapping[str, str]
    min_size: tuple[str, int] | None = None

    def gate(self) -> Column:
        known = all_present(self.keys)
        return known & (quoted(self.min_size[0]) >= self.min_size[1]) if self.min_size else known


def rank_rows(
    df: DataFrame,
    row_key: str,
    keys: Sequence[str],
    measures: Mapping[str, str],
    rounded: bool = True,
    min_size: tuple[str, int] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Percent ranks of many measures at once within one kind of group; see ``rank_groups``."""
    return rank_groups(df, row_key, [Ranking(keys, measures, min_size)], rounded, weight=weight)


def rank_groups(
    df: DataFrame,
    row_key: str,
    rankings: Sequence[Ranking],
    rounded: bool = True,
    source: DataFrame | None = None,
    weight: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Percent ranks of many measures within several kinds of groups: ``row_key`` and one column per rank.

    The rows are turned to (group, measure, value), whatever the kind of group, so all
    rankings share one pass and one index. Only ranked rows appear; join the result to
    ``df`` by the key, or name the columns to ``keep``, which come with every row of ``df``.
    Build rankings from one table rather than from each other's results.
    ``source`` holds the rows to rank among where those are more than the rows of ``df``;
    ``weight`` is its column with the number of rows that each one stands for.
    """
    source = df if source is None else source
    entries = [Entry(r.keys, m, r.gate()) for r in rankings for m in r.measures.values()]
    names = [new for r in rankings for new in r.measures]
    group, values = group_columns(entries), value_names(source, entries)
    long = long_values(source, entries, *([weight] if weight else []))
    index = pin(order_index(long, group, values, weight))
    if is_short(index, group):
        ranked = listed_ranks(df, [row_key, *(keep or [])], entries, names, index, rounded)
        if keep is not None:
            return ranked
        some = ranked.where(F.coalesce(*[quoted(n) for n in names]).isNotNull())
        # A key that repeats is one row, as it is after a shuffle of the long rows.
        return some.groupBy(quoted(row_key)).agg(*[F.max(quoted(n)).alias(n) for n in names])
    ranked = shuffled_ranks(df, row_key, entries, names, index, rounded)
    return ranked if keep is None else select_cols(df, [row_key, *keep]).join(ranked, row_key, "left")


def is_short(index: DataFrame, group: Sequence[str]) -> bool:
    """Whether the index fits into lists that every task holds and a row looks through."""
    lists = index.groupBy(*[quoted(c) for c in group]).agg(F.count(F.lit(1)).alias("values"))
    found = lists.agg(F.sum("values").alias("rows"), F.max("values").alias("longest")).first()
    rows, longest = (int(index.sparkSession.conf.get(k, str(n))) for k, n in (LISTED_ROWS, LISTED_VALUES))
    return (found["rows"] or 0) <= rows and (found["longest"] or 0) <= longest


def listed_ranks(
    df: DataFrame, kept: Sequence[str], entries: Sequence[Entry], names: Sequence[str], index: DataFrame, rounded: bool
) -> DataFrame:
    """Ranks from a short index: each group's values and percents as lists, joined to the rows where these stand."""
    places = value_columns(df, [e.measure for e in entries])
    by_keys: dict[tuple[str, ...], list[int]] = {}
    for i, e in enumerate(entries):
        by_keys.setdefault(tuple(e.keys), []).append(i)
    columns = [*kept, *group_columns(entries)[:-1], *[e.measure for e in entries]]
    looked = select_cols(df.withColumns({f"__gate{i}": e.gate for i, e in enumerate(entries)}), [*columns, *[f"__gate{i}" for i in range(len(entries))]])
    pct = F.bround(percent(), 0) if rounded else percent()
    for keys, numbers in by_keys.items():
        lists = {
            f"__l{i}": F.collect_list(
                F.when(F.col("__measure") == i, F.struct(F.col(places[entries[i].measure]).alias("v"), pct.alias("p")))
            )
            for i in numbers
        }
        groups = group_stats(index.where(F.col("__measure").isin(numbers)), keys, lists)
        split = {f"__{part}{i}": F.col(f"__l{i}.{part}") for i in numbers for part in "vp"}
        looked = looked.join(F.broadcast(groups.withColumns(split).drop(*lists)), list(keys), "left")

    def rank(i: int, e: Entry) -> Column:
        place = F.array_position(f"__v{i}", quoted(e.measure)) - 1
        return F.when(F.col(f"__gate{i}"), F.get(f"__p{i}", place))

    ranks = [rank(i, e).alias(new) for (i, e), new in zip(enumerate(entries), names)]
    return looked.select(*[quoted(c) for c in kept], *ranks)


def shuffled_ranks(
    df: DataFrame, row_key: str, entries: Sequence[Entry], names: Sequence[str], index: DataFrame, rounded: bool
) -> DataFrame:
    """Ranks from an index of any size: one join of the long rows, which become rows again by their key."""
    on = [*group_columns(entries), *value_names(df, entries)]
    looked = lookup_join(
        long_values(df, entries, row_key),
        index.select(*[quoted(c) for c in on], percent().alias("__pct")),
        on,
        # Every value has its rank, so this equals an inner join; but only the ranks,
        # never the long rows, can be the broadcast side.
        "left",
        counted_directory(index, on, "__n"),
    )
    # After a broadcast join the values of a row are still in one task and become
    # one row again before this shuffle.
    pct = F.bround("__pct", 0) if rounded else F.col("__pct")
    return looked.groupBy(row_key).agg(
        *[F.max(F.when(F.col("__measure") == i, pct)).alias(new) for i, new in enumerate(names)]
    )


def attach_median(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
) -> DataFrame:
    """Exact group medians ``{new column: measure}``: mean of the middle two values."""
    return lookup_join(df, group_medians(df, keys, measures), keys, "left")


def group_medians(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """One row per group with the medians of all measures, picked by position from one index."""
    names = list(measures.values())
    places = value_columns(df, names)
    entries = [Entry(keys, m, all_present(keys)) for m in names]
    index = order_index(long_values(df, entries), group_columns(entries), value_names(df, entries))

    def at(place: Column, name: str) -> Column:
        inside = (place > F.col("__below")) & (place <= F.col("__below") + F.col("__n"))
        return F.when(inside, F.col(places[name]))

    low, high = F.floor((F.col("__total") + 1) / 2), F.ceil((F.col("__total") + 1) / 2)
    middles = {}
    for i, (new, m) in enumerate(measures.items()):
        mine = F.col("__measure") == i
        pair = [F.max(F.when(mine, at(place, m))) for place in (low, high)]
        middles[new] = (pair[0] + pair[1]) / F.lit(2.0)
    return group_stats(index, keys, middles)


def attach_lag(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    lags: Mapping[str, tuple[str, int]],
) -> DataFrame:
    """Earlier values ``{new column: (column, steps)}`` of the same key; NULL at its start.

    ``order`` must end in a column that makes it unique within the key.
    """
    by = [quoted(c).asc_nulls_first() for c in order]

    def earlier(window) -> dict[str, Column]:
        return {
            new: F.when(quoted(key).isNotNull(), F.lag(quoted(c), n).over(window))
            for new, (c, n) in lags.items()
        }

    depth = max(n for _, n in lags.values())
    segments = sorted_segments(df, [quoted(key), *by])
    inside = Window.partitionBy("__seg", quoted(key))
    numbered = segments.withColumns(
        {
            **earlier(inside.orderBy(*by)),
            "__from_start": F.row_number().over(inside.orderBy(*by)),
            "__from_end": F.row_number().over(
                inside.orderBy(*[quoted(c).desc_nulls_last() for c in order])
            ),
        }
    )
    # First and last rows of each piece of a key that lies in several segments:
    # whatever a piece's first rows look back at is among these.
    pieces = segments.groupBy(quoted(key)).agg(
        F.min("__seg").alias("__first_seg"), F.max("__seg").alias("__last_seg")
    )
    spanning = pieces.where(F.col("__first_seg") < F.col("__last_seg")).select(quoted(key))
    # At most one key lies across each border, so this list has fewer rows than segments.
    edges = numbered.where(
        (F.col("__from_start") <= depth) | (F.col("__from_end") <= depth)
    ).join(F.broadcast(spanning), key, "left_semi")
    across = edges.withColumns(earlier(Window.partitionBy(quoted(key)).orderBy(*by))).where(
        F.col("__from_start") <= depth
    )
    on = ["__seg", key, "__from_start"]
    fixes = across.select(
        *on, F.lit(1).alias("__fix"), *[quoted(n).alias(f"__x_{n}") for n in lags]
    )
    fixed = numbered.join(fixes, on, "left").withColumns(
        {
            n: F.when(F.col("__fix") == 1, F.col(f"`__x_{n}`")).otherwise(quoted(n))
            for n in lags
        }
    )
    return fixed.select(*[quoted(c) for c in df.columns], *[quoted(n) for n in lags])


# A value for the places of other types in a row of the index, so that rows compare as wholes.
FILLERS = {T.StringType: "", T.DateType: "1970-01-01", T.TimestampType: "1970-01-01", T.TimestampNTZType: "1970-01-01", T.BooleanType: "false"}


def value_columns(df: DataFrame, measures: Sequence[str]) -> dict[str, str]:
    """The index column each measure's values stand in: one per data type."""
    types = list(dict.fromkeys(df.schema[m].dataType for m in measures))
    return {m: f"__v{types.index(df.schema[m].dataType)}" for m in measures}


@dataclass(frozen=True)
class Entry:
    """A measure to index within ``keys``, for the rows that pass ``gate``."""

    keys: Sequence[str]
    measure: str
    gate: Column


def group_columns(entries: Sequence[Entry]) -> list[str]:
    return [*dict.fromkeys(k for e in entries for k in e.keys), "__measure"]


def value_names(df: DataFrame, entries: Sequence[Entry]) -> list[str]:
    return list(dict.fromkeys(value_columns(df, [e.measure for e in entries]).values()))


def filler(kind: T.DataType) -> Column:
    return F.lit(FILLERS.get(type(kind), "0")).cast(kind)


def long_values(df: DataFrame, entries: Sequence[Entry], *more: str) -> DataFrame:
    """One row per known value: keys, the entry's number and the value, the value in its type's column.

    Keys and values of other entries hold fillers, so that rows compare as wholes. Keys that
    all entries have stand beside the list of values and are not repeated in it.
    """
    measures = [e.measure for e in entries]
    places = value_columns(df, measures)
    types = {places[m]: df.schema[m].dataType for m in measures}
    keys = group_columns(entries)[:-1]
    shared = [k for k in keys if all(k in e.keys for e in entries)]

    def one(i: int, e: Entry) -> Column:
        own = [
            (quoted(k) if k in e.keys else filler(df.schema[k].dataType)).alias(k) for k in keys if k not in shared
        ]
        values = [
            (quoted(e.measure) if place == places[e.measure] else filler(kind)).alias(place)
            for place, kind in types.items()
        ]
        known = (e.gate & quoted(e.measure).isNotNull()).alias("__known")
        return F.struct(*own, F.lit(i).alias("__measure"), known, *values)

    listed = F.array(*[one(i, e) for i, e in enumerate(entries)])
    long = df.select(*[quoted(k) for k in dict.fromkeys([*more, *shared])], F.inline(listed))
    return long.where("__known").drop("__known")


def percent() -> Column:
    """Percent rank of a value of the index: its average rank over the known values, times 100."""
    mean_rank = F.col("__below") + (F.col("__n") + 1) / F.lit(2.0)
    return mean_rank / F.col("__total") * F.lit(100.0)


def order_index(
    long: DataFrame, group: Sequence[str], values: Sequence[str], weight: str | None = None
) -> DataFrame:
    """The order-statistic index of ``long_values``.

    Columns: the group's, the values', ``__n`` (rows with this value), ``__below`` (rows of
    the group with a smaller one), ``__total`` (rows of the group). A row counts as often as its ``weight`` says.
    """
    rows = F.sum(quoted(weight)) if weight else F.count(F.lit(1))
    counted = long.groupBy(*[quoted(c) for c in [*group, *values]]).agg(rows.alias("__n"))
    names, order = [quoted(c) for c in group], [quoted(c) for c in values]
    segments = sorted_segments(counted, [*names, *order])
    piece = Window.partitionBy("__seg", *names)
    before = piece.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = segments.withColumns(
        {
            "__here": F.coalesce(F.sum("__n").over(before), F.lit(0)),
            "__inside": F.sum("__n").over(piece),
        }
    )
    carried = carried_sums(segments, group)
    joined = local.join(F.broadcast(carried), ["__seg", *group], "left")
    return joined.select(
        *names,
        *order,
        "__n",
        (F.col("__here") + F.coalesce(F.col("__before"), F.lit(0))).alias("__below"),
        F.coalesce(F.col("__all"), F.col("__inside")).alias("__total"),
    )


def carried_sums(segments: DataFrame, group: Sequence[str]) -> DataFrame:
    """For groups that lie in several segments: rows in earlier segments and in all.

    Only one group lies on a border, so there are at most two rows per segment.
    """
    names = [quoted(c) for c in group]
    sums = segments.groupBy("__seg", *names).agg(F.sum("__n").alias("__sum"))
    whole = Window.partitionBy(*names)
    earlier = whole.orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        "__seg",
        *names,
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__sum").over(whole).alias("__all"),
        F.count(F.lit(1)).over(whole).alias("__pieces"),
    ).where(F.col("__pieces") > 1).drop("__pieces")


def sorted_segments(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range partitioned by ``order`` with the pinned partition number ``__seg``."""
    ranged = df.repartitionByRange(tasks(df), *order)
    return pin(ranged.withColumn("__seg", F.spark_partition_id()))
