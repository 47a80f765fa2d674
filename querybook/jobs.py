"""Whole jobs on input tables derived from the given ones."""

from __future__ import annotations

from gradewell.plans import allegations, certifications, deficiencies, scorecard, service_area
from gradewell.specs.publish import NETWORK_COLUMNS, SCORECARD_COLUMNS
from pyspark.sql import functions as F
from pyspark.sql import types as T
from querybook import jobs_sql
from querybook.inputs import ASOF, derived, derived_tables
from querybook.tools import iso, register

QUERIES: dict = {}
SQL: dict[str, str] = {}


def six_places(c):
    """``round(c, 6)`` of a double. Its decimal arithmetic is needed only near a tie and for large numbers."""
    millions = c * F.lit(1e6)
    clear = (F.abs(c) < 1e6) & (F.abs(millions - F.floor(millions) - 0.5) > 0.01)
    return F.when(clear, F.rint(millions) / F.lit(1e6) + F.lit(0.0)).otherwise(F.round(c, 6))


def comparable(df):
    """Dates as text; numbers as doubles with six places, so NULLs need no own type."""

    def shown(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DoubleType):
            c = six_places(c)
        elif isinstance(field.dataType, T.DateType):
            c = iso(c)
        return c.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def finding_rows(spark, folder):
    return deficiencies.deficiency_rows(
        derived(spark, folder, "health_deficiencies"),
        derived(spark, folder, "complaint_surveys"),
        derived(spark, folder, "patient_survey"),
        derived(spark, folder, "zip_county"),
        ASOF,
    )


@register(QUERIES, SQL, jobs_sql.deficiency_table())
def deficiency_table(spark, folder):
    return comparable(finding_rows(spark, folder))


@register(QUERIES, SQL, jobs_sql.deficiency_summary_table())
def deficiency_summary_table(spark, folder):
    return comparable(deficiencies.deficiency_summary(finding_rows(spark, folder)))


@register(QUERIES, SQL, jobs_sql.allegation_table())
def allegation_table(spark, folder):
    details = derived(spark, folder, "complaint_details")
    return comparable(allegations.latest_allegations(details, ASOF))


@register(QUERIES, SQL, jobs_sql.certification_table())
def certification_table(spark, folder):
    out = certifications.latest_certifications(derived(spark, folder, "certifications"))
    return comparable(out.select(*jobs_sql.CERTIFICATION_COLUMNS))


@register(QUERIES, SQL, jobs_sql.service_area_table())
def service_area_table(spark, folder):
    out = service_area.service_area(
        derived(spark, folder, "provider_zips"), derived(spark, folder, "zip_county")
    )
    return comparable(out)


@register(QUERIES, SQL, jobs_sql.state_benchmark_table())
def state_benchmark_table(spark, folder):
    out = service_area.state_benchmark(
        derived(spark, folder, "facility_rates"), derived(spark, folder, "facilities_monthly")
    )
    return comparable(out)


@register(QUERIES, SQL, jobs_sql.scorecard_table(SCORECARD_COLUMNS))
def scorecard_table(spark, folder):
    return comparable(scorecard.scorecard(derived_tables(spark, folder), ASOF))


@register(QUERIES, SQL, jobs_sql.scorecard_table(NETWORK_COLUMNS))
def network_table(spark, folder):
    full = scorecard.full_table(derived_tables(spark, folder), ASOF)
    return comparable(scorecard.network(full))
