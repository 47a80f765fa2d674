"""Equi joins that hold when one key owns a large share of the rows.

``lookup_join`` is the work horse. The left side may have hot keys; the right
side is a table of at most a few rows per key (group statistics, ranks,
per-provider summaries). Rows of a hot key are spread over salts and the right
rows of that key are repeated once per salt (``spread``); no row is dropped.
There is one way for all sizes: where the directory finds no hot key, the join is
the plain one, and Spark broadcasts the right side by its measured size.

Finding hot keys reads the key columns of the left side once. Chains of joins do
that once for all their key sets, on the base table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gradewell.operators.spread import Chain, HotKeys
from gradewell.session import pin


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left or inner join on equal column names, safe for hot keys on the left."""
    return Chain(left, on, hot=hot).join(right, on, how).done()


def left_join(left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """Left join on differently named keys; both keys stay."""
    return left.join(right, left[lkey] == right[rkey], "left")


def dim_join(df: DataFrame, dim: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """Inner join with a dimension.

    No broadcast hint: Spark broadcasts by measured size and otherwise shuffles
    both plain inputs, which AQE can split where a key is hot.
    """
    return df.join(dim, df[lkey] == dim[rkey], "inner")


def fold_sides(
    columns: Sequence[str], sides: Sequence[tuple[DataFrame, Sequence[str]]]
) -> list[tuple[DataFrame, list[str]]]:
    """The sides with keys in ``columns``, each with the sides folded in that hang on it.

    A side whose keys only an earlier side brings in is joined to that side, which is
    smaller than the base, and comes to the base with it.
    """
    kept: list[tuple[DataFrame, list[str]]] = []
    for side, on in sides:
        if not set(on) <= set(columns):
            holders = [i for i, (k, _) in enumerate(kept) if set(on) <= set(k.columns)]
            if holders:
                holder, keys = kept[holders[0]]
                kept[holders[0]] = (lookup_join(holder, side, on, "left"), keys)
                continue
        kept.append((side, list(on)))
    return kept


def star_join(
    base: DataFrame,
    sides: Sequence[tuple[DataFrame, Sequence[str]]],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left joins of several sides to one base, each on its own key columns.

    All key sets of the base share one directory and one spread number. Sides that
    hang on another side are joined to that one first. Keys gathered from
    several sides have no single holder; the table so far is pinned for them.
    """
    kept = fold_sides(base.columns, sides)
    chain = Chain(base, *[on for _, on in kept if set(on) <= set(base.columns)], hot=hot)
    for side, on in kept:
        if not set(on) <= set(base.columns):
            chain = Chain(pin(chain.done()), on)
        chain.join(side, on)
    return chain.done()


def reduce_join(dfs: Sequence[DataFrame], on: Sequence[str], hot: HotKeys | None = None) -> DataFrame:
    """Inner join of all tables on the same keys; hot keys are those of the first table."""
    chain = Chain(dfs[0], on, hot=hot)
    for side in dfs[1:]:
        chain.join(side, on, "inner")
    return chain.done()


def join_suffixed(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join where non-key columns of the same name get a suffix per side."""
    shared = (set(left.columns) & set(right.columns)) - set(on)

    def marked(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: c + suffix for c in df.columns if c in shared})

    return lookup_join(marked(left, suffixes[0]), marked(right, suffixes[1]), on, how)

