"""Service area: one row per county and provider, and the state facility benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.functions.text import compound_key, pad_code
from gradewell.operators.columns import decode_binary
from gradewell.operators.filters import distinct_keys, require
from gradewell.operators.groups import attach, group_mean
from gradewell.operators.joins import lookup_join
from gradewell.operators.picks import last_per_group
from gradewell.session import pin


def service_area(provider_zips: DataFrame, zip_county: DataFrame) -> DataFrame:
    """Counties each provider serves; ``County_count`` is the providers of the county."""
    counties = distinct_keys(
        zip_county.select(pad_code("zip_code", 5).alias("zip_code"), "county"), "zip_code", "county"
    )
    served = provider_zips.select(
        "state",
        pad_code("cms_certification_number_ccn", 6).alias("cms_certification_number_ccn"),
        pad_code("zip_code", 5).alias("zip_code"),
    )
    both = lookup_join(pin(require(served, ["zip_code"])), counties, ["zip_code"], "inner")
    both = both.withColumn("County_ID", compound_key("state", "county"))
    one = last_per_group(both, ["County_ID", "cms_certification_number_ccn"], ["zip_code"])
    return attach(pin(one), ["County_ID"], {"County_count": F.count("cms_certification_number_ccn")})


def state_benchmark(rates: DataFrame, facilities: DataFrame) -> DataFrame:
    """Mean adjusted facility rate per state, each facility at its latest survey."""
    newest = last_per_group(decode_binary(facilities), ["PROV_NUM"], ["Survey_date", "STATE_ABBREV"])
    placed = lookup_join(
        pin(decode_binary(rates).select("CCN", "rate_adj")),
        newest.select(F.col("PROV_NUM").alias("CCN"), "Survey_date", "STATE_ABBREV"),
        ["CCN"],
        "left",
    )
    one = last_per_group(placed, ["CCN"], ["Survey_date", "rate_adj"])
    return group_mean(one, ["STATE_ABBREV"], "rate_adj", "rate_adj")
