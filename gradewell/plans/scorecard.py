"""Scorecard: one row per county and provider with scores, ranks, letters and rates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.functions import scoring
from gradewell.functions.dates import reporting_month
from gradewell.functions.flags import decode, decode_contains, rule_flags, yes_no
from gradewell.functions.numbers import drop_nan, ratio, row_mean, to_number
from gradewell.functions.text import pad_code, swap, title
from gradewell.operators.columns import (
    derive,
    drop_matching,
    fill_defaults,
    normalize_headers,
    quoted,
    rename,
    scale,
    select_cols,
)
from gradewell.operators.filters import allow, require
from gradewell.operators.groups import group_stats, share, total
from gradewell.operators.joins import lookup_join, star_join
from gradewell.operators.picks import dedup
from gradewell.operators.ranks import Ranking, rank_groups, rank_rows
from gradewell.operators.spread import counted_directory
from gradewell.plans.allegations import latest_allegations
from gradewell.plans.certifications import latest_certifications
from gradewell.plans.deficiencies import deficiency_rows, deficiency_summary
from gradewell.plans.service_area import service_area, state_benchmark
from gradewell.run import Run
from gradewell.sources.sinks import write_by
from gradewell.specs.measures import EMERGENCY as EMERGENCY_HEADER
from gradewell.specs.measures import MEASURES
from gradewell.specs.measures import READMITTED as READMITTED_HEADER
from gradewell.specs.models import OUTCOMES, Outcome
from gradewell.specs.publish import NETWORK_COLUMNS, SCORECARD_COLUMNS, STATES
from gradewell.specs.rules import RULES

CCN = "cms_certification_number_ccn"
MIN_COUNTY = 40

# Service columns shared by the quality and the patient-survey table (fixed values).
SERVICES = [
    "offers_nursing_care_services",
    "offers_physical_therapy_services",
    "offers_occupational_therapy_services",
    "offers_speech_pathology_services",
    "offers_medical_social_services",
    "offers_home_health_aide_services",
]
# Published service answers and the certification column behind each (fixed values).
SERVICE_ANSWERS = {
    "Lab_Service_Binary": "LAB_SRVC_DESC",
    "Pharm_Service_Binary": "PHRMCY_SRVC_DESC",
    "Nursing_Service_Binary": "NRSNG_SRVC_DESC",
    "PT_Service_Binary": "PT_SRVC_DESC",
    "OT_Service_Binary": "OCPTNL_THRPST_SRVC_DESC",
    "Speech_Service_Binary": "SPCH_THRPY_SRVC_DESC",
    "Med_SS_Service_Binary": "MDCL_SCL_SRVC_DESC",
    "HH_Aide_Service_Binary": "HH_AIDE_SRVC_DESC",
}
# Ownership texts and their label, a later match wins (fixed values).
OWNERSHIP = [
    ("Non - Profit", "Non-Profit"),
    ("Government", "Government"),
    ("Proprietary", "For-Profit"),
]
# Comparison texts and their letter (fixed values).
COMPARISONS = {
    "Worse Than Expected": "D",
    "Same As Expected": "C",
    "Better Than Expected": "A",
}
# Shares by state or county and the flag behind each (fixed values).
SHARES = {
    "def": "def_binary",
    "alleg": "alleg_binary",
    "sub_alleg": "sub_alleg_bin",
    "rehosp_alleg": "rehosp_bin",
    "comp_bin": "comp_binary",
}
# Patient-survey flags whose county means the full table has.
SURVEY_FLAGS = [r.flag for r in RULES if r.flag.startswith("HC_")]


def provider_table(df: DataFrame) -> DataFrame:
    """Quality or patient-survey table with short measure names and padded ids."""
    short = {m.header: m.name for m in MEASURES}
    named = rename(drop_matching(normalize_headers(df), "footnote"), short)
    return named.withColumns({CCN: pad_code(CCN, 6), "city": title("city")})


def quality_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    quality = provider_table(tables["quality_measures"])
    return quality.select(
        CCN,
        "state",
        *SERVICES,
        "provider_name",
        "address",
        "type_of_ownership",
        "date_certified",
        "quality_of_patient_care_star_rating",
        quoted(READMITTED_HEADER),
        quoted(EMERGENCY_HEADER),
        *[m.name for m in MEASURES if m.name in quality.columns],
    )


def survey_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    survey = provider_table(tables["patient_survey"])
    return survey.select(
        CCN,
        "state",
        *SERVICES,
        "city",
        "hhcahps_survey_summary_star_rating",
        "number_of_completed_surveys",
        "response_rate",
        *[to_number(m.name).alias(m.name) for m in MEASURES if m.name in survey.columns],
    )


def deficiency_totals(tables: Mapping[str, DataFrame], asof: dt.date | str) -> DataFrame:
    rows = deficiency_rows(
        tables["health_deficiencies"],
        tables["complaint_surveys"],
        tables["patient_survey"],
        tables["zip_county"],
        asof,
    )
    return deficiency_summary(rows).select(
        F.col("PRVDR_NUM").alias(CCN),
        "state",
        "def_total",
        "tagcount_lastsurv",
        "tagcount_complaint",
        "comp_binary",
        "def_binary",
        *[r.column for r in RULES if r.flag.startswith("def_")],
        "def_comp_assess",
    )


def provider_key() -> Column:
    """Provider and state as one value that also joins where a part is missing."""
    return F.struct(CCN, "state")


def service_rows(run: Run, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The service area, a base of the run: one row per county and provider."""
    return run.base("service_area", lambda: service_area(tables["provider_zips"], tables["zip_county"]))


def served_providers(run: Run, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The providers and states of the service area with ``served``, the number of their counties; a base of the run."""
    area = service_rows(run, tables)
    return run.base("providers", lambda: area.groupBy(CCN, "state").agg(F.count(F.lit(1)).alias("served")))


def joined_rows(run: Run, tables: Mapping[str, DataFrame], asof: dt.date | str) -> DataFrame:
    """Each provider and state of the service area with all provider tables joined, each a base of the run.

    The tables' keys are the provider and the state, so the counties of a provider, of
    which there may be many, need not be told apart here.
    """

    def by_id(df: DataFrame) -> DataFrame:
        return rename(df, {"PRVDR_NUM": CCN})

    certified = run.base("certifications", lambda: by_id(latest_certifications(tables["certifications"])))
    benchmark = run.base(
        "state_benchmark",
        lambda: state_benchmark(tables["facility_rates"], tables["facilities_monthly"]),
    )
    quality = run.base("quality", lambda: quality_rows(tables))
    survey = run.base("survey", lambda: survey_rows(tables))
    deficiencies = run.base("deficiencies", lambda: deficiency_totals(tables, asof))
    allegations = run.base(
        "allegations", lambda: by_id(latest_allegations(tables["complaint_details"], asof))
    )
    return star_join(
        served_providers(run, tables).select(CCN, "state"),
        [
            (certified, [CCN]),
            (benchmark.withColumn("state", F.col("STATE_ABBREV")), ["state"]),
            (quality, [CCN, "state"]),
            (survey, [CCN, "state", *SERVICES]),
            (deficiencies, [CCN, "state"]),
            (allegations, [CCN]),
        ],
    )


def add_flags(df: DataFrame) -> DataFrame:
    """Row means, ratios and the threshold flags of the rule table."""
    licensed = F.col("RN_CNT") + F.col("LPN_LVN_CNT")
    admits = "census_undup_admit_per_year"
    ratios = {
        "qm_immun_shots": row_mean("m_qm_flu_shot", "m_qm_pneum_shot"),
        "qm_func_status_avg": row_mean(
            "m_qm_improv_mobil", "m_qm_improv_trans", "m_qm_bathing", "m_qm_pain_moving"
        ),
        "rn_over_tot_licensed": ratio("RN_CNT", licensed),
        "aide_over_tot_licensed": ratio("HHA_AIDE_CNT", licensed),
        "tot_licensed_per_100_undup_admit": ratio(licensed, admits, 100),
        "rn_per_100_undup_admit": ratio("RN_CNT", admits, 100),
        "cen_readmit_over_cen_undup": ratio("CNSUS_ADMSN_READMSN_CNT", "CNSUS_ADMSN_UNDUPD_CNT"),
        "cen_nh_over_cen_nh_hosp": ratio(
            "NH_DSCHRG_CNT", F.col("NH_DSCHRG_CNT") + F.col("CNSUS_HOSP_DSCHRG_CNT")
        ),
        "cen_death_over_cen_undup": ratio("CNSUS_DEATH_DSCHRG_CNT", "CNSUS_ADMSN_UNDUPD_CNT"),
        "cen_goal_met_over_cen_undup": ratio("CNSUS_DSCHRG_GOAL_MET_CNT", "CNSUS_ADMSN_UNDUPD_CNT"),
        "weighted_alleg_binary": F.col("weight_flag"),
    }
    return derive(derive(drop_nan(df), ratios), rule_flags(RULES))


def add_scores(df: DataFrame, outcomes: Mapping[str, Outcome] = OUTCOMES) -> DataFrame:
    """Scores, bins and estimates of every outcome, one column stage per step."""

    def stage(step) -> dict[str, Column]:
        return {name: c for o, spec in outcomes.items() for name, c in step(o, spec).items()}

    def linear(o: str, spec: Outcome) -> dict[str, Column]:
        return {
            f"logit_{o}_worst": scoring.linear_score(spec.worst.betas, spec.worst.intercept),
            f"logit_{o}_best": scoring.linear_score(spec.best.betas, spec.best.intercept),
        }

    def predicted(o: str, _: Outcome) -> dict[str, Column]:
        return {f"pred_{o}_{m}": scoring.logistic(f"logit_{o}_{m}") for m in ("worst", "best")}

    def difference(o: str, _: Outcome) -> dict[str, Column]:
        diff = F.col(f"pred_{o}_best") - F.col(f"pred_{o}_worst")
        return {f"pred_{o}_diff": diff, f"score_missing_{o}": diff.isNull().cast("int")}

    def binned(o: str, spec: Outcome) -> dict[str, Column]:
        label = scoring.bin_by(f"pred_{o}_diff", spec.breaks)
        return {f"oe_{o}_ptile": scoring.shrink(label, spec.small_flag)}

    def estimate(o: str, spec: Outcome) -> dict[str, Column]:
        steps = scoring.step_map(f"oe_{o}_ptile", spec.steps, spec.last_step)
        return {f"oe_{o}_estimate": steps}

    for step in (linear, predicted, difference, binned, estimate):
        df = derive(df, stage(step))
    return df


def state_stats(values: DataFrame) -> DataFrame:
    """Medians, sums and shares per state. Providers count once per served county, as the table has them."""
    # An estimate takes at most nine values, so the medians' value maps stay small.
    return group_stats(
        values,
        ["state"],
        {
            **{
                f"oe_{o}_state_median": F.percentile(f"oe_{o}_estimate", F.lit(0.5), F.col("served"))
                for o in OUTCOMES
            },
            **{f"{name}_sum": total(quoted(flag) * F.col("served")) for name, flag in SHARES.items()},
            **{f"{name}_state_mean": share(flag, "served") for name, flag in SHARES.items()},
        },
    )


def county_stats(kept: DataFrame) -> DataFrame:
    """Shares and patient-survey means per county, and its number of rows."""
    return group_stats(
        kept,
        ["County_ID"],
        {
            **{f"{name}_county_mean": share(flag) for name, flag in SHARES.items()},
            **{f"{flag.removesuffix('_binary')}_mean": F.avg(flag) for flag in SURVEY_FLAGS},
            "__rows": F.count(F.lit(1)),
        },
    )


def provider_values(run: Run, tables: Mapping[str, DataFrame], asof: dt.date | str) -> DataFrame:
    """What ranks and statistics need of each scored provider, a base of the run.

    Where a source names a provider twice, all its rows have a place in the ranks, but
    only the first is ``kept`` for the table. The row number only parts rows that are equal in all
    that goes before it in the order. As every county of a provider has the same rows,
    the choice is made once per provider and state.
    """
    flags = [*SHARES.values(), *SURVEY_FLAGS, *[spec.small_flag for spec in OUTCOMES.values()]]
    scores = [c for o in OUTCOMES for c in (f"pred_{o}_diff", f"oe_{o}_estimate")]
    first = ["CRTFCTN_DT", "provider_name", "address"]
    providers = scored_providers(run, tables, asof)

    def present(names: Sequence[str]) -> list[str]:
        return [c for c in dict.fromkeys(names) if c in providers.columns]

    order = present([*first, *flags, *scores, "provider_id"])

    def build() -> DataFrame:
        kept = dedup(select_cols(providers, ["provider", *order]), ["provider"], order).select(
            "provider_id", F.lit(True).alias("kept")
        )
        columns = present(["provider", "provider_id", *flags, *scores, *[m.name for m in MEASURES]])
        served = served_providers(run, tables).select(provider_key().alias("provider"), "served")
        values = lookup_join(select_cols(providers, columns), served, ["provider"])
        values = values.join(kept, "provider_id", "left").withColumn("state", F.col("provider.state"))
        return values.withColumn("kept", F.col("kept").isNotNull())

    return run.base("provider_values", build)


def grade_rows(values: DataFrame) -> DataFrame:
    """State ranks, percentiles and letters of the kept providers, by ``provider_id``.

    State ranks use all rows of the table, of which a provider has one for each county. The
    score differences of the kept rows are ranked within the state and become letters.
    """
    flags = [spec.small_flag for spec in OUTCOMES.values()]
    estimates = [f"oe_{o}_estimate" for o in OUTCOMES]
    kept = values.where("kept")
    graded = rank_groups(
        kept,
        "provider_id",
        [Ranking(["state"], {m.state_rank: m.name for m in MEASURES})],
        source=values,
        weight="served",
        keep=["state", "served", *flags, *estimates],
    )
    percentiles = rank_rows(
        kept,
        "provider_id",
        ["state"],
        {spec.percentile: f"pred_{o}_diff" for o, spec in OUTCOMES.items()},
        rounded=False,
        weight="served",
    )
    letters = {
        spec.letter: scoring.clamp_letter(scoring.letter_grade(spec.percentile), spec.small_flag)
        for spec in OUTCOMES.values()
    }
    return derive(graded.join(percentiles, "provider_id", "left"), letters)


def rank_counties(scored: DataFrame) -> DataFrame:
    """Each row of the table, which has the kept ones, with its ranks in counties of at least 40 providers."""
    ranking = Ranking(
        ["County_ID"], {m.county_rank: m.name for m in MEASURES}, ("County_count", MIN_COUNTY)
    )
    columns = ["provider_id", "County_ID", "County_count", "county", "zip_code"]
    return rank_groups(scored.where("kept"), "row_id", [ranking], source=scored, keep=columns)


def letter_means(
    df: DataFrame, pairs: Mapping[str, tuple[str, str]], weight: str | None = None
) -> DataFrame:
    """One row: for each ``{name: (letter, value)}`` a map of the value's mean by letter.

    One grouped mean over (number of the pair, letter), with at most six letters each. A
    row counts as often as its ``weight`` says.
    """
    rows = quoted(weight) if weight else F.lit(1)
    listed = F.array(
        *[
            F.struct(
                F.lit(i).alias("pair"),
                F.col(letter).alias("letter"),
                F.col(value).cast("double").alias("value"),
            )
            for i, (letter, value) in enumerate(pairs.values())
        ]
    )
    long = df.select(rows.alias("rows"), F.inline(listed)).where(F.col("letter").isin(*scoring.ALL_LETTERS))
    weighed = F.try_divide(F.sum(F.col("value") * F.col("rows")), F.sum(F.when(F.col("value").isNotNull(), F.col("rows"))))
    means = group_stats(long, ["pair", "letter"], {"mean": weighed if weight else F.avg("value")})
    entry = F.struct("letter", "mean")
    return means.agg(
        *[
            F.map_from_entries(F.collect_list(F.when(F.col("pair") == i, entry))).alias(name)
            for i, name in enumerate(pairs)
        ]
    )


def attach_letter_means(
    df: DataFrame,
    pairs: Mapping[str, tuple[str, str]],
    source: DataFrame | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Every row with the national mean of its letter, for each pair.

    The means are a scalar subquery: one row of small maps, and no join.
    """
    means = letter_means(df if source is None else source, pairs, weight)
    row = means.select(F.struct(*pairs)).scalar()
    found = {
        name: F.try_element_at(F.col("__means")[name], F.col(letter))
        for name, (letter, _) in pairs.items()
    }
    return df.withColumn("__means", row).withColumns(found).drop("__means")


def add_rates(df: DataFrame, graded: DataFrame) -> DataFrame:
    """Expected rates: letter mean and state median times the base rate."""
    pairs = {f"__mean_{o}": (spec.letter, f"oe_{o}_estimate") for o, spec in OUTCOMES.items()}
    rates = {}
    for o, spec in OUTCOMES.items():
        rates[f"{spec.rates}_comp_rate"] = F.col(f"__mean_{o}") * F.lit(spec.letter_base)
        rates[f"{spec.rates}_state_rate"] = F.col(f"oe_{o}_state_median") * F.lit(spec.state_base)
    return derive(attach_letter_means(df, pairs, graded, "served"), rates).drop(*pairs)


def add_provider_text(df: DataFrame, asof: dt.date | str) -> DataFrame:
    """Published texts that depend on the provider and state alone."""
    answers = {name: yes_no(col, "NOT PROVIDED") for name, col in SERVICE_ANSWERS.items()}
    texts = {
        "Ownership_Type": decode_contains("type_of_ownership", OWNERSHIP, "N/A"),
        "qm_pac_urgent_care_no_hosp_rank": decode(quoted(EMERGENCY_HEADER), COMPARISONS, "N/A"),
        "qm_pac_hosp_admitt_rank": decode(quoted(READMITTED_HEADER), COMPARISONS, "N/A"),
        "CMS_ID": F.concat(F.lit("'"), F.col(CCN)),
        "address": F.upper(swap("address", ",", " ")),
        "city": F.upper("city"),
        "State_Srv": F.col("STATE_ABBREV"),
        "state": F.upper("state"),
        "provider_name": title(swap("provider_name", ",", " ")),
        "Reporting_Month": reporting_month(asof),
    }
    filled = {
        "def_total": 0,
        "alleg_total": 0,
        "tagcount_lastsurv": 0,
        "tagcount_complaint": 0,
        "m_hcaps_discuss_med": "N/A",
        "m_hcaps_communicated": "N/A",
        "m_qm_admit_hosp": "N/A",
        "quality_of_patient_care_star_rating": "N/A",
    }
    return fill_defaults(require(derive(df, {**answers, **texts}), ["state"]), filled)


def add_county_text(df: DataFrame) -> DataFrame:
    """Published texts that depend on the county."""
    texts = {
        "qm_urgent_care_no_hosp_rank": scoring.letter_grade("qm_urgent_care_norehosp_county_ptile"),
        "qm_hosp_admit_ptile_rank": scoring.letter_grade("qm_admit_hosp_county_ptile"),
        "Ecosystem_Name": F.col("County_ID"),
    }
    return derive(df, texts)


def needed_columns() -> list[str]:
    """Scored columns that the statistics and the extracts use; other flags are not stored."""
    made_later = {m.state_rank for m in MEASURES} | {m.county_rank for m in MEASURES}
    published = [c for c in SCORECARD_COLUMNS if c not in made_later]
    return [
        "row_id",
        CCN,
        "County_ID",
        "STATE_ABBREV",
        "type_of_ownership",
        *SERVICE_ANSWERS.values(),
        *SHARES.values(),
        *SURVEY_FLAGS,
        *[m.name for m in MEASURES],
        *[spec.small_flag for spec in OUTCOMES.values()],
        *[c for o in OUTCOMES for c in (f"pred_{o}_diff", f"oe_{o}_estimate", f"score_missing_{o}")],
        *published,
    ]


def scored_providers(run: Run, tables: Mapping[str, DataFrame], asof: dt.date | str) -> DataFrame:
    """Joined, flagged and scored rows of each provider and state, a base of the run with a row number.

    The number is only written down once, so it means the same row to all readers.
    """

    def build() -> DataFrame:
        scored = add_scores(add_flags(joined_rows(run, tables, asof)))
        kept = [c for c in dict.fromkeys(needed_columns()) if c in scored.columns and c not in (CCN, "state")]
        named = scored.withColumns({"provider": provider_key(), "provider_id": F.monotonically_increasing_id()})
        return select_cols(named, ["provider", "provider_id", *kept])

    return run.base("scored_providers", build)


def score_rows(run: Run, tables: Mapping[str, DataFrame], asof: dt.date | str) -> DataFrame:
    """The rows of the table, a base of the run with a row number: every county of each scored provider.

    Flags and scores are made once per provider and state and then joined to its counties;
    here are those that ranks and statistics need. The wide rest waits for the last join.
    """

    def build() -> DataFrame:
        area = service_rows(run, tables).withColumn("provider", provider_key())
        values = provider_values(run, tables, asof)
        not_used = [c for o, spec in OUTCOMES.items() for c in (f"pred_{o}_diff", spec.small_flag)]
        scored = lookup_join(area, values.drop("state", "served", *not_used), ["provider"]).drop("provider")
        return scored.withColumn("row_id", F.monotonically_increasing_id())

    return run.base("scored", build)


def published_providers(
    run: Run, tables: Mapping[str, DataFrame], asof: dt.date | str, values: DataFrame
) -> DataFrame:
    """All that is published of the kept providers and does not depend on the county, a base of the run."""
    graded = run.base("graded", lambda: grade_rows(values))
    ranks = [m.state_rank for m in MEASURES]
    letters = [spec.letter for spec in OUTCOMES.values()]

    def build() -> DataFrame:
        grades = select_cols(graded, ["provider_id", "state", *ranks, *letters])
        grades = add_rates(lookup_join(grades, state_stats(values), ["state"]), graded).drop("state")
        providers = scored_providers(run, tables, asof).withColumns(
            {CCN: F.col(f"provider.{CCN}"), "state": F.col("provider.state")}
        )
        rows = scale(providers, [m.name for m in MEASURES], 100).drop("provider").join(grades, "provider_id")
        return add_provider_text(rows, asof)

    return run.base("published_providers", build)


def full_table(
    tables: Mapping[str, DataFrame], asof: dt.date | str, run: Run | None = None
) -> DataFrame:
    """Every stored column of the scorecard.

    All that depends on the provider and state alone is made once for these; only the county ranks
    and shares are made on the rows of the table, which are narrow until the last join.
    Without a run of the caller's the bases stay in the shared folder.
    """
    run = run or Run(next(iter(tables.values())).sparkSession)
    scored = score_rows(run, tables, asof)
    providers = published_providers(run, tables, asof, provider_values(run, tables, asof))
    counties = run.base("county_stats", lambda: county_stats(scored.where("kept")))
    hot = counted_directory(counties, ["County_ID"], "__rows")
    rows = lookup_join(rank_counties(scored), counties.drop("__rows"), ["County_ID"], "left", hot)
    return add_county_text(rows.join(providers, "provider_id").drop("provider_id"))


def published(full: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of an extract, measures under their source headers."""
    return select_cols(rename(full, {m.name: m.header for m in MEASURES}), columns)


def scorecard(tables: Mapping[str, DataFrame], asof: dt.date | str) -> DataFrame:
    return published(full_table(tables, asof), SCORECARD_COLUMNS)


def network(full: DataFrame) -> DataFrame:
    return published(full, NETWORK_COLUMNS)


def publish(run: Run, full: DataFrame, folder: str) -> None:
    """Both extracts, one folder of sorted CSV files per published state."""
    columns = list(dict.fromkeys([*SCORECARD_COLUMNS, *NETWORK_COLUMNS]))
    rows = run.base("published", lambda: allow(published(full, columns), "state", STATES))
    write_by(
        select_cols(rows, SCORECARD_COLUMNS),
        "state",
        STATES,
        f"{folder}/scorecard",
        ["Ecosystem_Name", "provider_name", "CMS_ID"],
    )
    write_by(
        select_cols(rows, NETWORK_COLUMNS), "state", STATES, f"{folder}/network", ["county", "provider_name", "CMS_ID"]
    )


def run_scorecard(tables: Mapping[str, DataFrame], asof: dt.date | str, folder: str) -> None:
    """Scorecard and network extract of one run, whose bases go at its end."""
    with Run(next(iter(tables.values())).sparkSession) as run:
        publish(run, full_table(tables, asof, run), folder)
