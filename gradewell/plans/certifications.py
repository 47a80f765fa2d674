"""Certification table: latest certification per provider with yearly volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell.functions.dates import compact_date, gap_days
from gradewell.functions.flags import below_flags
from gradewell.functions.numbers import ratio
from gradewell.functions.text import column, pad_code
from gradewell.operators.columns import derive, drop_matching, rename
from gradewell.operators.filters import require
from gradewell.operators.picks import top_n_per_group
from gradewell.specs.rules import SMALL_LIMITS

NAMES = {
    "PRVDR_CCN": "PRVDR_NUM",
    "CLNDR_CRTFCTN_DT_SK": "CRTFCTN_DT",
    "CLNDR_CRTFCTN_UPDT_DT_SK": "CRTFCTN_UPDT_DT",
}
# Counts turned into yearly volumes (fixed values).
PER_YEAR = {
    "census_undup_admit_per_year": "CNSUS_ADMSN_UNDUPD_CNT",
    "census_readmis_admit_per_year": "CNSUS_ADMSN_READMSN_CNT",
    "census_discharge_hosp_per_year": "CNSUS_HOSP_DSCHRG_CNT",
    "census_discharge_snf_per_year": "NH_DSCHRG_CNT",
    "census_dischrg_goal_per_year": "CNSUS_DSCHRG_GOAL_MET_CNT",
    "census_dischrg_death_per_year": "CNSUS_DEATH_DSCHRG_CNT",
    "discharge_count_per_year": "DSCHRG_CNT",
}
SHORT_GAP_DAYS = 100
SHORT_GAP_ADMITS = 1000


def survey_gap(
    gap1: Column | str, gap2: Column | str, admits: Column | str, limit: float = SHORT_GAP_ADMITS
) -> Column:
    """Days the counts cover.

    A gap of one day, or a short one with many admissions, is a correction of
    the certification before it; the days then run from the one before that.
    """
    gap, volume = column(gap1), column(admits)
    correction = (gap == 1) | (gap.between(1, SHORT_GAP_DAYS) & (volume > limit))
    return F.when(correction, column(gap2)).otherwise(gap)


def per_year(count: Column | str, days: Column | str) -> Column:
    return ratio(count, column(days) / F.lit(365.0))


def latest_certifications(certifications: DataFrame) -> DataFrame:
    """One row per provider. Only its last three certifications reach the shuffle."""
    named = drop_matching(rename(certifications, NAMES), "NA")
    dated = named.withColumns(
        {
            "PRVDR_NUM": pad_code("PRVDR_NUM", 6),
            "CRTFCTN_DT": compact_date("CRTFCTN_DT"),
            "CRTFCTN_UPDT_DT": F.col("CRTFCTN_UPDT_DT").cast("string"),
        }
    )
    newest_first = [
        F.col("CRTFCTN_DT").desc_nulls_last(),
        F.col("CRTFCTN_UPDT_DT").desc_nulls_last(),
        F.col("CNSUS_ADMSN_UNDUPD_CNT").desc_nulls_last(),
        # Ends in the whole row, so only equal rows tie.
        *[F.col(f"`{c}`").desc_nulls_last() for c in sorted(dated.columns)],
    ]
    last_three = top_n_per_group(require(dated, ["PRVDR_NUM"]), ["PRVDR_NUM"], newest_first, 3)
    back = Window.partitionBy("PRVDR_NUM").orderBy("__rn")
    gaps = last_three.withColumns(
        {
            "lag_survey_date": F.lead("CRTFCTN_DT", 1).over(back),
            "lag_survey_date2": F.lead("CRTFCTN_DT", 2).over(back),
        }
    ).where(F.col("__rn") == 1)
    days = survey_gap(
        gap_days("CRTFCTN_DT", "lag_survey_date"),
        gap_days("CRTFCTN_DT", "lag_survey_date2"),
        "CNSUS_ADMSN_UNDUPD_CNT",
    )
    yearly = derive(
        gaps.withColumn("survey_days", days),
        {name: per_year(count, "survey_days") for name, count in PER_YEAR.items()},
    )
    flags = below_flags("census_undup_admit_per_year", SMALL_LIMITS)
    return derive(
        yearly, {**flags, "CRTFCTN_DT": F.date_format("CRTFCTN_DT", "yyyyMMdd")}
    ).drop("__rn")
