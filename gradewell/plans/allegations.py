"""Allegation table: totals of each provider's latest complaint exit day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.functions.dates import compact_date, in_lookback
from gradewell.functions.flags import decode, flag
from gradewell.functions.text import pad_code
from gradewell.operators.filters import require
from gradewell.operators.groups import group_stats
from gradewell.operators.picks import last_per_group
from gradewell.specs import rules

LOOKBACK_MONTHS = 18


def finding_weight(finding: Column | str) -> Column:
    return decode(finding, rules.FINDING_WEIGHTS, 0)


def allegation_tests(kind: Column, finding: Column) -> dict[str, Column]:
    return {
        "sub": finding.isin(list(rules.SUBSTANTIATED)),
        "qoc": kind.isin(list(rules.QUALITY_OF_CARE)),
        "abu_neg": kind.isin(list(rules.ABUSE_NEGLECT)),
        "staff": kind.isin(list(rules.STAFFING)),
        "rehosp": kind.isin(list(rules.REHOSPITALISATION)),
    }


def latest_allegations(details: DataFrame, asof: dt.date | str) -> DataFrame:
    """One row per provider: totals of its latest exit day and its last allegation."""
    dated = details.select(
        pad_code("PRVDR_CCN", 6).alias("PRVDR_NUM"),
        compact_date("CLNDR_EXIT_DT_SK").alias("EXIT_DT"),
        F.col("ALGTN_TYPE_CD").try_cast("int").alias("ALGTN_TYPE_CD"),
        F.col("ALGTN_FNDNG_CD").try_cast("int").alias("ALGTN_FNDNG_CD"),
    )
    dated = require(dated.where(in_lookback("EXIT_DT", asof, LOOKBACK_MONTHS)), ["ALGTN_TYPE_CD"])
    # One row per allegation type and day, the lowest finding where there are several.
    single = group_stats(
        dated,
        ["PRVDR_NUM", "EXIT_DT", "ALGTN_TYPE_CD"],
        {"ALGTN_FNDNG_CD": F.min("ALGTN_FNDNG_CD")},
    )
    kind, finding = F.col("ALGTN_TYPE_CD"), F.col("ALGTN_FNDNG_CD")
    tests = allegation_tests(kind, finding)
    by_day = group_stats(
        single,
        ["PRVDR_NUM", "EXIT_DT"],
        {
            "alleg_total": F.count(finding),
            "alleg_rows": F.count(F.lit(1)),
            **{f"total_{name}_alleg": F.count_if(test) for name, test in tests.items()},
            **{
                f"weight_of_{code}": F.count_if(finding == code) * F.lit(weight)
                for code, weight in rules.FINDING_WEIGHTS.items()
            },
            "last_row": F.max(F.struct("ALGTN_TYPE_CD", "ALGTN_FNDNG_CD")),
        },
    )
    latest = last_per_group(by_day, ["PRVDR_NUM"], ["EXIT_DT"])
    latest = latest.select("*", "last_row.*").drop("last_row")
    same_finding = {code: F.col(f"weight_of_{code}") for code in rules.FINDING_WEIGHTS}
    return latest.withColumns(
        {
            **{f"{name}_bin": flag(test) for name, test in tests.items() if name != "sub"},
            "sub_alleg_bin": flag(tests["sub"]),
            "weight_flag": finding_weight("ALGTN_FNDNG_CD"),
            "total_weight_alleg": F.when(
                finding.isNotNull(), decode("ALGTN_FNDNG_CD", same_finding, F.lit(0).cast("bigint"))
            ),
        }
    ).drop(*[f"weight_of_{code}" for code in rules.FINDING_WEIGHTS])
