"""Date expressions. The as-of date is always a parameter, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradewell.functions.text import column


def as_date(value: Column | dt.date | str) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def compact_date(c: Column | str) -> Column:
    """``2020-01-31`` or ``20200131`` to a date; anything else to NULL."""
    return F.try_to_date(F.replace(column(c), F.lit("-"), F.lit("")), "yyyyMMdd")


def us_date(c: Column | str) -> Column:
    """``MM/DD/YYYY``, padded or not, to a date; bad text to NULL."""
    return F.try_to_date(column(c), "M/d/yyyy")


def year_month(c: Column | str) -> Column:
    """``YYYY-M`` with the month not padded; NULL stays NULL."""
    day = us_date(c)
    return F.concat(F.year(day).cast("string"), F.lit("-"), F.month(day).cast("string"))


def gap_days(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(column(later), column(earlier))


def gap_years(later: Column | str, earlier: Column | str) -> Column:
    return gap_days(later, earlier) / F.lit(365.0)


def in_lookback(day: Column | str, asof: Column | dt.date | str, months: int) -> Column:
    """``day`` in the half-open window (asof - months, asof]."""
    end = as_date(asof)
    return (column(day) > F.add_months(end, -months)) & (column(day) <= end)


def reporting_month(asof: Column | dt.date | str) -> Column:
    return F.date_format(as_date(asof), "yyyy/MM")
