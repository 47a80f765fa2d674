"""Hot keys: a directory of them, and salts that keep their spread over a chain of joins.

The directory is a frequent-items sketch per key set over the hashes of its keys:
one pass over the key columns, partial sketches merged, nothing shuffled by key. It
holds every key with more rows than a task's fair part (rows / shuffle partitions,
or ``maxRowsPerTask`` where that is less). No more keys than partitions can have
that, which bounds the list that comes to the driver and goes to the tasks. The list
steers the spread alone: a key that is missing, or there without need, changes no result.

A row's salt comes from its spread number, a hash of the row's content and of the
task that read it. It is made once at the base of a chain and carried along, so a
later join spreads as evenly as the first. It does not depend on row order, so a
retried task sends a row to the same place. ``numbered`` pins a row number instead,
for a base that comes out of a shuffle and repeats whole rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewell.operators.columns import quoted
from gradewell.session import pin

# Session setting and its default: the most rows one key may bring to one task.
MAX_ROWS = ("spark.gradewell.maxRowsPerTask", 2_000_000)
SPREAD = "__spread"
# Pieces a hot key is cut into for each fair part it fills, so that they even out over the tasks.
PIECES = 4
HotKeys = dict[tuple[str, ...], dict[int, int]]


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fair_rows(df: DataFrame, total: int) -> int:
    """Rows of each task if all got equally many, ``maxRowsPerTask`` at most."""
    key, default = MAX_ROWS
    return max(min(int(df.sparkSession.conf.get(key, str(default))), ceil(total / tasks(df))), 1)


def key_hash(keys: Sequence[str], like: DataFrame | None = None) -> Column:
    """Hash of a key, taken as the column types of ``like`` have it."""
    parts = [quoted(k) if like is None else quoted(k).try_cast(like.schema[k].dataType) for k in keys]
    return F.xxhash64(*parts)


def pieces(rows: int, fair: int) -> int:
    return ceil(rows * PIECES / fair) if rows > fair else 1


def directory(df: DataFrame, *key_sets: Sequence[str]) -> HotKeys:
    """Number of salts by key hash, for each key set that has hot keys; one pass over ``df``."""
    sets = list(dict.fromkeys(tuple(k) for k in key_sets))
    most = max(tasks(df), 16)
    # A sketch of m counters misses no key above 3.5 / m of its rows.
    counters = min(1 << (8 * most - 1).bit_length(), 1 << 19)
    hashes = F.array(*[F.struct(F.lit(i).alias("i"), key_hash(k).alias("h")) for i, k in enumerate(sets)])
    found = (
        df.select(F.inline(hashes))
        .groupBy("i")
        .agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(h, {most}, {counters})").alias("top"))
        .collect()
    )
    hot: HotKeys = {}
    for r in found:
        fair = fair_rows(df, r["rows"])
        salts = {t["item"]: pieces(t["count"], fair) for t in r["top"] if t["count"] > fair}
        if salts:
            hot[sets[r["i"]]] = salts
    return hot


def counted_directory(counts: DataFrame, keys: Sequence[str], rows: str) -> HotKeys:
    """The same from a table that has each key with its number of rows already."""
    total = counts.agg(F.sum(quoted(rows)).alias("n")).first()["n"] or 0
    fair = fair_rows(counts, total)
    most = counts.where(quoted(rows) > fair).select(key_hash(keys).alias("h"), quoted(rows).alias("n"))
    salts = {r["h"]: pieces(r["n"], fair) for r in most.collect()}
    return {tuple(keys): salts} if salts else {}


def spread_number(df: DataFrame) -> Column:
    return F.xxhash64(F.spark_partition_id(), *[quoted(c) for c in df.columns])


def with_spread(df: DataFrame) -> DataFrame:
    """``df`` with its spread number, unless it carries one already."""
    return df if SPREAD in df.columns else df.withColumn(SPREAD, spread_number(df))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` pinned with a row number as its spread number, which tells equal rows apart."""
    return pin(df.withColumn(SPREAD, F.xxhash64(F.monotonically_increasing_id())))


def salts_of(df: DataFrame, keys: Sequence[str], salts: dict[int, int], like: DataFrame | None = None) -> DataFrame:
    """``df`` with ``__salts``, the number of salts of its row's key, NULL for a key that is not hot."""
    schema = T.StructType([T.StructField("__key_hash", T.LongType()), T.StructField("__salts", T.IntegerType())])
    listed = df.sparkSession.createDataFrame(list(salts.items()), schema)
    hashed = df.withColumn("__key_hash", key_hash(keys, like))
    return hashed.join(F.broadcast(listed), "__key_hash", "left").drop("__key_hash")


def salt_left(df: DataFrame, keys: Sequence[str], salts: dict[int, int], name: str) -> DataFrame:
    """Salt of every row, from its spread number."""
    salt = F.coalesce(F.pmod(F.xxhash64(SPREAD), F.col("__salts")), F.lit(0)).cast("int")
    return salts_of(df, keys, salts).withColumn(name, salt).drop("__salts")


def salt_right(df: DataFrame, keys: Sequence[str], salts: dict[int, int], name: str, like: DataFrame) -> DataFrame:
    """Every row once for each salt of its key; ``like`` is the left table."""
    each = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    return salts_of(df, keys, salts, like).withColumn(name, F.explode(each)).drop("__salts")


class Chain:
    """Joins of one base with tables of few rows per key, on one or several key sets.

    A key set's salt is made once and stays in the table, so joins that follow
    on the same keys find the rows where they are.
    """

    def __init__(self, base: DataFrame, *key_sets: Sequence[str], hot: HotKeys | None = None):
        self.hot = directory(base, *key_sets) if hot is None else hot
        self.columns = list(base.columns)
        self.salted: dict[tuple[str, ...], str] = {}
        self.df = with_spread(base) if self.hot else base

    def join(self, right: DataFrame, on: Sequence[str], how: str = "left") -> Chain:
        on = list(on)
        salts = self.hot.get(tuple(on))
        if not salts:
            self.df = self.df.join(right, on, how)
        else:
            name = self.salted.setdefault(tuple(on), f"__salt{len(self.salted)}")
            if name not in self.df.columns:
                self.df = salt_left(self.df, on, salts, name)
            copies = salt_right(right, on, salts, name, like=self.df)
            self.df = self.df.join(copies, [*on, name], how)
        return self

    def done(self) -> DataFrame:
        made = [*self.salted.values(), *([SPREAD] if SPREAD not in self.columns else [])]
        return self.df.drop(*made)
