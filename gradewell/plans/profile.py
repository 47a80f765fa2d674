"""Profile of the encounter table and the run over a set of chosen files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewell.functions.dates import year_month
from gradewell.operators.groups import rollup_counts
from gradewell.sources.tables import load_classified, lower_headers

GROUPS = ["EncType", "Admitting_Source", "Discharge_Disposition", "Discharge_Status"]


def encounter_profile(encounter: DataFrame) -> DataFrame:
    """Rows per encounter type, source, disposition, status, admission month and discharge day.

    A missing value is a group of its own.
    """
    by_name = {c.lower(): c for c in encounter.columns}
    columns = [F.col(by_name[g.lower()]).alias(g) for g in GROUPS]
    rows = encounter.select(
        *columns,
        year_month(by_name["adate"]).alias("YearMonth"),
        F.col(by_name["ddate"]).alias("DDate"),
    )
    return rows.groupBy(*GROUPS, "YearMonth", "DDate").agg(F.count(F.lit(1)).alias("count"))


def encounter_rollup(profile: DataFrame) -> DataFrame:
    return rollup_counts(profile, ["EncType", "DDate"])


def run_profile(spark: SparkSession, paths: Sequence[str]) -> dict[str, DataFrame]:
    """Recognise the chosen files and profile the encounter table; without one there is no profile."""
    tables = load_classified(spark, paths)
    if "ENCOUNTER" not in tables:
        return {}
    profile = encounter_profile(lower_headers(tables["ENCOUNTER"]))
    return {"profile": profile, "rollup": encounter_rollup(profile)}
