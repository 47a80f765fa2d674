"""Deficiency table: survey findings per provider and their summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradewell.functions.dates import compact_date, in_lookback
from gradewell.functions.flags import decode, present
from gradewell.functions.text import pad_code, tag_code
from gradewell.operators.columns import normalize_headers, rename, select_cols, union_all
from gradewell.operators.filters import allow, distinct_keys, in_cycle_windows, require
from gradewell.operators.groups import group_stats
from gradewell.operators.joins import lookup_join
from gradewell.operators.picks import dedup, first_per_group, rows_of_latest
from gradewell.session import pin
from gradewell.sources.sinks import write_by
from gradewell.specs.publish import STATES
from gradewell.specs.tags import TAG_LISTS

# Input headers of the two sources (fixed values).
STANDARD_NAMES = {
    "PRVDR_CCN": "PRVDR_NUM",
    "CLNDR_SRVY_DT_SK": "SRVY_DT",
    "TAG_NUM": "DFCNCY_TAG_NUM",
    "PREX_CD": "DFCNCY_PREX_CD",
}
COMPLAINT_NAMES = {
    "PRVDR_CCN": "PRVDR_NUM",
    "CLNDR_SRVY_DT_SK_10": "SRVY_DT",
    "SRVY_CYC_CD_4": "SRVY_CYC_CD",
    "TAG_NUM_15": "DFCNCY_TAG_NUM",
    "PREX_CD_16": "DFCNCY_PREX_CD",
}
FINDING_COLUMNS = ["PRVDR_NUM", "SRVY_DT", "SRVY_CYC_CD", "DFCNCY_TAG_NUM", "DFCNCY_PREX_CD"]
# Lookback in months per cycle code (fixed values).
CYCLE_MONTHS = {"S": 36, "C": 18}
OUTPUT_COLUMNS = [
    "provider_name",
    "address",
    "PRVDR_NUM",
    "state",
    "zip",
    "SRVY_DT",
    "SRVY_CYC_CD",
    "DFCNCY_TAG_NUM",
    "tagcount_lastsurv",
    "tagcount_complaint",
]


def latest_findings(source: DataFrame, names: dict[str, str], rank: int) -> DataFrame:
    """Findings of each provider's latest survey in one source."""
    found = select_cols(rename(source, names), FINDING_COLUMNS)
    found = found.withColumn("PRVDR_NUM", pad_code("PRVDR_NUM", 6))
    return rows_of_latest(found, "PRVDR_NUM", "SRVY_DT").withColumn("source", F.lit(rank))


def surveyed_providers(survey: DataFrame, zip_county: DataFrame) -> DataFrame:
    """One row per provider whose zip code has a county."""
    zips = distinct_keys(zip_county.select(pad_code("zip_code", 5).alias("zip")), "zip")
    providers = normalize_headers(survey).select(
        pad_code("cms_certification_number_ccn", 6).alias("PRVDR_NUM"),
        "provider_name",
        "address",
        "state",
        pad_code("zip", 5).alias("zip"),
    )
    known = lookup_join(pin(providers), zips, ["zip"], "inner")
    return first_per_group(known, ["PRVDR_NUM"], ["provider_name", "address", "state", "zip"])


def deficiency_rows(
    health: DataFrame,
    complaints: DataFrame,
    survey: DataFrame,
    zip_county: DataFrame,
    asof: dt.date | str,
) -> DataFrame:
    """One row per (provider, survey day, cycle, tag) within the lookback windows."""
    found = union_all(
        [
            latest_findings(health, STANDARD_NAMES, 0),
            latest_findings(complaints, COMPLAINT_NAMES, 1),
        ]
    ).withColumns(
        {
            "SRVY_DT": compact_date("SRVY_DT"),
            "DFCNCY_TAG_NUM": tag_code("DFCNCY_PREX_CD", "DFCNCY_TAG_NUM"),
        }
    )
    # The day is part of the key below, so days no window reaches can go before the joins.
    found = found.where(in_lookback("SRVY_DT", asof, max(CYCLE_MONTHS.values())))
    found = require(found, ["DFCNCY_TAG_NUM"]).drop("DFCNCY_PREX_CD")
    # The latest findings of the window are a small part of both sources; what follows reads them only.
    found = pin(found)
    found = lookup_join(found, surveyed_providers(survey, zip_county), ["PRVDR_NUM"], "inner")
    # The cycle is not part of this key: a tag cited in both cycles on one day
    # stays with the standard source.
    found = dedup(found, ["PRVDR_NUM", "SRVY_DT", "DFCNCY_TAG_NUM"], ["source", "SRVY_CYC_CD"])
    found = in_cycle_windows(found, "SRVY_CYC_CD", "SRVY_DT", asof, CYCLE_MONTHS)

    # A provider has at most its two latest survey days here and one row per tag
    # code and day, so these groups are small whatever the input.
    tag_count = F.count("DFCNCY_TAG_NUM").over(
        Window.partitionBy("PRVDR_NUM", "SRVY_DT", "SRVY_CYC_CD")
    )
    is_standard = F.col("SRVY_CYC_CD") == "S"
    last_complaint = F.max(F.when(~is_standard, F.struct("SRVY_DT", "tag_count"))).over(
        Window.partitionBy("PRVDR_NUM")
    )
    rows = found.withColumn("tag_count", tag_count).withColumns(
        {
            "tagcount_lastsurv": F.when(is_standard, F.col("tag_count")),
            "tagcount_complaint": F.when(is_standard, last_complaint["tag_count"]).otherwise(
                F.col("tag_count")
            ),
        }
    )
    label = decode("SRVY_CYC_CD", {"S": "Standard"}, "Complaint")
    return select_cols(rows.withColumn("SRVY_CYC_CD", label), OUTPUT_COLUMNS)


def export_rows(rows: DataFrame, path: str) -> None:
    """The findings of the published states, one folder of sorted files each."""
    write_by(pin(allow(rows, "state", STATES)), "state", STATES, path, ["provider_name", "SRVY_DT", "DFCNCY_TAG_NUM"])


def deficiency_summary(rows: DataFrame) -> DataFrame:
    """One row per provider: its earliest survey day in ``rows`` with counts per category."""
    first_row = F.min(
        F.struct("DFCNCY_TAG_NUM", "SRVY_CYC_CD", "state", "tagcount_lastsurv", "tagcount_complaint")
    )
    tag = F.col("DFCNCY_TAG_NUM")
    by_day = group_stats(
        rows,
        ["PRVDR_NUM", "SRVY_DT"],
        {
            "def_total": F.count(tag),
            **{name: F.count_if(tag.isin(tags)) for name, tags in TAG_LISTS.items()},
            "first_row": first_row,
        },
    )
    earliest = first_per_group(by_day, ["PRVDR_NUM"], ["SRVY_DT"])
    return earliest.select("*", "first_row.*").drop("first_row").withColumns(
        {
            "comp_binary": present("tagcount_complaint"),
            "def_binary": present("DFCNCY_TAG_NUM"),
        }
    )
