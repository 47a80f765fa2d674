"""Row filters. All are plain predicates, so Catalyst pushes them to the scan."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.functions.dates import in_lookback
from gradewell.operators.columns import all_present, quoted


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where none of ``cols`` is NULL, as a predicate the scan can use."""
    return df.where(all_present(cols))


def exclude_matching(df: DataFrame, col: str, words: Sequence[str]) -> DataFrame:
    """Rows whose text holds none of the words (case-sensitive); NULL text stays."""
    found = quoted(col).rlike("|".join(re.escape(w) for w in words))
    return df.where(~F.coalesce(found, F.lit(False)))


def allow(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.where(quoted(col).isin(list(values)))


def in_cycle_windows(
    df: DataFrame, cycle: str, day: str, asof: Column | dt.date | str, months: Mapping[str, int]
) -> DataFrame:
    """Rows of each cycle code within that code's own lookback window."""
    test = F.lit(False)
    for code, span in months.items():
        test = test | ((quoted(cycle) == code) & in_lookback(day, asof, span))
    return df.where(test)


def distinct_keys(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[quoted(c) for c in cols]).distinct()
