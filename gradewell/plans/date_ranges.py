"""Measure date ranges: published list of measures and the period each covers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gradewell.functions.text import swap
from gradewell.operators.columns import apply_to, normalize_headers, select_cols
from gradewell.operators.filters import exclude_matching, require
from gradewell.sources.sinks import write_single

# Measures whose name holds one of these are left out (fixed values).
EXCLUDED_WORDS = ("Average", "31 days", "medication issues", "ulcers")
COLUMNS = ["measure_name", "measure_date_range"]


def measure_date_ranges(ranges: DataFrame) -> DataFrame:
    table = select_cols(normalize_headers(ranges), COLUMNS)
    table = apply_to(table, COLUMNS, lambda c: swap(c, ",", ";"))
    return exclude_matching(require(table, ["measure_name"]), "measure_name", EXCLUDED_WORDS)


def export_date_ranges(ranges: DataFrame, path: str, files: int = 1) -> None:
    write_single(measure_date_ranges(ranges), path, files)
