"""Number expressions that never raise: bad text and zero divisors give NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewell.functions.text import column, to_int_text


__all__ = ["drop_nan", "ratio", "round_even", "row_mean", "to_int_text", "to_number"]


def to_number(c: Column | str) -> Column:
    return column(c).try_cast("double")


def ratio(top: Column | str, bottom: Column | str, scale: float = 1.0) -> Column:
    value = F.try_divide(column(top).cast("double"), column(bottom).cast("double"))
    return value if scale == 1.0 else value * F.lit(float(scale))


def row_mean(*cols: Column | str) -> Column:
    """Mean of the given columns, NULL if any of them is NULL."""
    total = reduce(lambda a, b: a + b, [column(c).cast("double") for c in cols])
    return total / F.lit(float(len(cols)))


def round_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(column(c), digits)


def drop_nan(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN to NULL in every float column, so that comparisons treat it as missing."""
    floats = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (cols is None or f.name in cols)
    ]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})
