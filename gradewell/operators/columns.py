"""Operators on the set of columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def all_present(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in cols])


def select_cols(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns, each once, in the given order."""
    return df.select(*[quoted(n) for n in dict.fromkeys(names)])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def header_name(name: str) -> str:
    """Trimmed, lower case, spaces to ``_``, without brackets and commas."""
    return re.sub(r"[(),]", "", name.strip().lower().replace(" ", "_"))


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[header_name(c) for c in df.columns])


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(*[quoted(c) for c in df.columns if not re.search(pattern, c)])


def drop_dup_columns(df: DataFrame) -> DataFrame:
    """Keep the first column of each name."""
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    first: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        first.setdefault(name, i)
    return numbered.select(*[F.col(f"c{i}").alias(name) for name, i in first.items()])


def derive(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(exprs))


def scale(df: DataFrame, cols: Sequence[str], divisor: float) -> DataFrame:
    return df.withColumns({c: quoted(c) / F.lit(float(divisor)) for c in cols})


def cols_of_type(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def apply_to(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    chosen = set(cols)
    return df.select(*[fn(quoted(c)).alias(c) if c in chosen else quoted(c) for c in df.columns])


def decode_binary(df: DataFrame) -> DataFrame:
    """Every binary column as UTF-8 text."""
    return apply_to(df, cols_of_type(df, T.BinaryType), lambda c: F.decode(c, "UTF-8"))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL. A text default turns the column into text first."""
    exprs = {}
    for name, value in defaults.items():
        c = quoted(name)
        exprs[name] = F.coalesce(c.cast("string") if isinstance(value, str) else c, F.lit(value))
    return df.withColumns(exprs)


def split_explode(df: DataFrame, col: str, sep: str = "|", keep: bool = False) -> DataFrame:
    """One row per part of ``col``; ``keep`` adds the whole text when it has several parts.

    Rows without a text are dropped.
    """
    parts = F.split(quoted(col), r"\Q" + sep + r"\E", -1)
    if keep:
        parts = F.when(F.size(parts) > 1, F.concat(F.array(quoted(col)), parts)).otherwise(parts)
    return df.select(*[F.explode(parts).alias(c) if c == col else quoted(c) for c in df.columns])


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name; absent columns are NULL; columns in sorted order."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out.select(*[quoted(c) for c in sorted(out.columns)])
