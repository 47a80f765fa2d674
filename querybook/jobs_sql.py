"""SQL of the whole jobs, written from their definitions rather than from the Spark code."""

from __future__ import annotations

from gradewell.functions.flags import Rule
from gradewell.plans.scorecard import EMERGENCY_HEADER, READMITTED_HEADER, SERVICES
from gradewell.specs import rules
from gradewell.specs.measures import MEASURES, QUALITY, SURVEY
from gradewell.specs.models import OUTCOMES, Model
from querybook.groups import rank_sql
from querybook.inputs import ASOF, HEADERS, ctes

# First and last tag number of each run.
TAG_RUNS = {
    "def_patient_rights": [(100, 116)],
    "def_compliance": [(117, 121)],
    "def_org_admin": [(122, 150)],
    "def_prof_personel": [(151, 155)],
    "def_med_poc": [(156, 166), (300, 300)],
    "def_report_info": [(320, 322), (324, 328)],
    "def_skilled_nurse": [(168, 183)],
    "def_therapy_service": [(184, 193)],
    "def_social_service": [(194, 201)],
    "def_hha_service": [(202, 233), (301, 302)],
    "def_clinical_records": [(235, 241), (303, 303)],
    "def_program_eval": [(242, 251)],
    "def_comp_assess": [(330, 342)],
}

DAY = f"DATE '{ASOF}'"


def pad(column: str, width: int) -> str:
    return f"(repeat('0', greatest({width} - length({column}), 0)) || {column})"


def num(expr: str, name: str) -> str:
    return f'round(CAST({expr} AS DOUBLE), 6) AS "{name}"'


def any_of(column: str, values) -> str:
    return "(" + " OR ".join(f"{column} = {v}" for v in values) + ")"


def in_runs(column: str, runs) -> str:
    return "(" + " OR ".join(f"{column} BETWEEN {a} AND {b}" for a, b in runs) + ")"


# Findings within the lookback windows, one row per provider, day and tag.
FINDINGS = f"""{ctes('health_deficiencies', 'complaint_surveys', 'patient_survey', 'zip_county')},
latest AS (
    SELECT *, 0 AS src FROM health_deficiencies h
    WHERE day = (SELECT max(day) FROM health_deficiencies i WHERE i.ccn = h.ccn)
    UNION ALL
    SELECT *, 1 AS src FROM complaint_surveys h
    WHERE day = (SELECT max(day) FROM complaint_surveys i WHERE i.ccn = h.ccn)),
coded AS (
    SELECT {pad('ccn', 6)} AS id, CAST(day AS DATE) AS d, cycle, src, CAST(tag AS INT) AS tag,
           'G-' || right('000' || CAST(tag AS INT), 4) AS code
    FROM latest WHERE tag BETWEEN 1 AND 9999),
placed AS (
    SELECT {pad('ccn', 6)} AS id, name, address, state, {pad('zip', 5)} AS zip FROM patient_survey
    WHERE {pad('zip', 5)} IN (SELECT {pad('zip', 5)} FROM zip_county)),
single AS (
    SELECT DISTINCT ON (id, d, code) * FROM coded JOIN placed USING (id) ORDER BY id, d, code, src, cycle),
found AS (
    SELECT * FROM single WHERE d <= {DAY}
      AND ((cycle = 'S' AND d > {DAY} - INTERVAL 36 MONTH)
        OR (cycle = 'C' AND d > {DAY} - INTERVAL 18 MONTH))),
complaints AS (
    SELECT id, n FROM (SELECT id, d, count(*) AS n FROM found WHERE cycle = 'C' GROUP BY 1, 2) x
    QUALIFY d = max(d) OVER (PARTITION BY id)),
findings AS (
    SELECT f.*, CASE f.cycle WHEN 'S' THEN 'Standard' ELSE 'Complaint' END AS label,
           CASE WHEN f.cycle = 'S' THEN count(*) OVER (PARTITION BY f.id, f.d, f.cycle) END AS lastsurv,
           CASE WHEN f.cycle = 'S' THEN c.n
                ELSE count(*) OVER (PARTITION BY f.id, f.d, f.cycle) END AS complaint
    FROM found f LEFT JOIN complaints c ON c.id = f.id)"""


def deficiency_table() -> str:
    return f"""WITH {FINDINGS}
        SELECT name AS provider_name, address, id AS "PRVDR_NUM", state, zip,
               strftime(d, '%Y-%m-%d') AS "SRVY_DT", label AS "SRVY_CYC_CD", code AS "DFCNCY_TAG_NUM",
               {num('lastsurv', 'tagcount_lastsurv')}, {num('complaint', 'tagcount_complaint')}
        FROM findings"""


CATEGORY_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE {in_runs('tag', runs)}) AS {name}" for name, runs in TAG_RUNS.items()
)
SUMMARY = f"""{FINDINGS},
first_day AS (SELECT * FROM findings QUALIFY d = min(d) OVER (PARTITION BY id)),
first_tag AS (SELECT DISTINCT ON (id) id, code, label, state, lastsurv, complaint
              FROM first_day ORDER BY id, code, label),
counted AS (SELECT id, min(d) AS d, count(*) AS def_total, {CATEGORY_COUNTS} FROM first_day GROUP BY 1),
deficiency AS (SELECT * FROM counted JOIN first_tag USING (id))"""


def deficiency_summary_table() -> str:
    return f"""WITH {SUMMARY}
        SELECT id AS "PRVDR_NUM", strftime(d, '%Y-%m-%d') AS "SRVY_DT", {num('def_total', 'def_total')},
               {', '.join(num(c, c) for c in TAG_RUNS)}, code AS "DFCNCY_TAG_NUM",
               label AS "SRVY_CYC_CD", state, {num('lastsurv', 'tagcount_lastsurv')},
               {num('complaint', 'tagcount_complaint')},
               {num('CASE WHEN complaint IS NULL THEN 0 ELSE 1 END', 'comp_binary')},
               {num('1', 'def_binary')}
        FROM deficiency"""


KINDS = {
    "qoc": rules.QUALITY_OF_CARE,
    "abu_neg": rules.ABUSE_NEGLECT,
    "staff": rules.STAFFING,
    "rehosp": rules.REHOSPITALISATION,
}
ALLEGATIONS = f"""{ctes('complaint_details')},
single_alleg AS (
    SELECT {pad('ccn', 6)} AS id, CAST(day AS DATE) AS d, kind, min(finding) AS finding
    FROM complaint_details
    WHERE kind IS NOT NULL AND CAST(day AS DATE) <= {DAY}
      AND CAST(day AS DATE) > {DAY} - INTERVAL 18 MONTH GROUP BY ALL),
last_alleg AS (SELECT * FROM single_alleg QUALIFY d = max(d) OVER (PARTITION BY id)),
alleg_totals AS (
    SELECT id, max(d) AS d, count(finding) AS alleg_total, count(*) AS alleg_rows,
           count(*) FILTER (WHERE finding = 1) AS total_sub_alleg,
           {', '.join(f"count(*) FILTER (WHERE {any_of('kind', v)}) AS total_{n}_alleg" for n, v in KINDS.items())}
    FROM last_alleg GROUP BY 1),
last_kind AS (SELECT DISTINCT ON (id) id, kind, finding FROM last_alleg ORDER BY id, kind DESC),
allegation AS (
    SELECT t.*, k.kind, k.finding, CASE WHEN finding = 1 THEN 1 ELSE 0 END AS sub_alleg_bin,
           {', '.join(f"CASE WHEN {any_of('kind', v)} THEN 1 ELSE 0 END AS {n}_bin" for n, v in KINDS.items())},
           CASE finding WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS weight_flag,
           (SELECT sum(CASE l.finding WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END) FROM last_alleg l
            WHERE l.id = t.id AND l.finding = k.finding) AS total_weight_alleg
    FROM alleg_totals t JOIN last_kind k USING (id))"""
ALLEGATION_NUMBERS = [
    "alleg_total",
    "alleg_rows",
    "total_sub_alleg",
    *[f"total_{n}_alleg" for n in KINDS],
    "sub_alleg_bin",
    *[f"{n}_bin" for n in KINDS],
    "weight_flag",
    "total_weight_alleg",
]


def allegation_table() -> str:
    return f"""WITH {ALLEGATIONS}
        SELECT id AS "PRVDR_NUM", strftime(d, '%Y-%m-%d') AS "EXIT_DT",
               {', '.join(num(c, c) for c in ALLEGATION_NUMBERS)},
               {num('kind', 'ALGTN_TYPE_CD')}, {num('finding', 'ALGTN_FNDNG_CD')} FROM allegation"""


YEARLY = {
    "census_undup_admit_per_year": "admits",
    "census_readmis_admit_per_year": "readmits",
    "census_discharge_hosp_per_year": "hospital",
    "census_discharge_snf_per_year": "nursing",
    "census_dischrg_goal_per_year": "goal",
    "census_dischrg_death_per_year": "died",
    "discharge_count_per_year": "discharged",
}
CERTIFICATIONS = f"""{ctes('certifications')},
certified AS (
    SELECT *, {pad('ccn', 6)} AS id, CAST(day AS DATE) AS d,
           lag(CAST(day AS DATE), 1) OVER w AS d1, lag(CAST(day AS DATE), 2) OVER w AS d2,
           count(*) OVER (PARTITION BY ccn) - row_number() OVER w AS behind
    FROM certifications WINDOW w AS (PARTITION BY ccn ORDER BY day, updated, admits)),
gapped AS (
    SELECT *, CASE WHEN d - d1 = 1 OR (d - d1 BETWEEN 1 AND 100 AND admits > 1000)
                   THEN d - d2 ELSE d - d1 END AS survey_days FROM certified WHERE behind = 0),
yearly AS (
    SELECT *, {', '.join(f"{c} / nullif(survey_days / 365.0, 0) AS {n}" for n, c in YEARLY.items())}
    FROM gapped),
certification AS (
    SELECT *, {', '.join(
        f"CASE WHEN census_undup_admit_per_year < {v} THEN 1 ELSE 0 END AS {n}"
        for n, v in rules.SMALL_LIMITS.items())} FROM yearly)"""
CERTIFICATION_COLUMNS = [
    "PRVDR_NUM",
    "CRTFCTN_DT",
    "CRTFCTN_UPDT_DT",
    "survey_days",
    *YEARLY,
    *rules.SMALL_LIMITS,
]


def certification_table() -> str:
    return f"""WITH {CERTIFICATIONS}
        SELECT id AS "PRVDR_NUM", strftime(d, '%Y%m%d') AS "CRTFCTN_DT", updated AS "CRTFCTN_UPDT_DT",
               {', '.join(num(c, c) for c in CERTIFICATION_COLUMNS[3:])} FROM certification"""


AREA = f"""{ctes('provider_zips')},
served AS (
    SELECT state || '_' || county AS county_id, {pad('ccn', 6)} AS id, state, county,
           max({pad('z.zip', 5)}) AS zip
    FROM provider_zips p JOIN zip_county z ON p.zip = z.zip GROUP BY ALL),
area AS (SELECT *, count(*) OVER (PARTITION BY county_id) AS county_count FROM served)"""


def service_area_table() -> str:
    return f"""WITH {ctes('zip_county')},
{AREA}
        SELECT county_id AS "County_ID", id AS cms_certification_number_ccn, state, county,
               zip AS zip_code, {num('county_count', 'County_count')} FROM area"""


BENCHMARK = f"""{ctes('facility_rates', 'facilities_monthly')},
benchmark AS (
    SELECT state, avg(rate) AS rate_adj
    FROM facility_rates r
    JOIN (SELECT ccn, arg_max(state, day) AS state FROM facilities_monthly GROUP BY 1) f ON r.ccn = f.ccn
    GROUP BY 1)"""


def state_benchmark_table() -> str:
    return f"""WITH {BENCHMARK}
        SELECT state AS "STATE_ABBREV", {num('rate_adj', 'rate_adj')} FROM benchmark"""


def rule_sql(r: Rule) -> str:
    if r.test == "between":
        test = f"{r.column} >= {r.value[0]} AND {r.column} <= {r.value[1]}"
    elif r.test == "in":
        test = any_of(r.column, [f"'{v}'" for v in r.value])
    else:
        value = f"'{r.value}'" if isinstance(r.value, str) else r.value
        test = f"{r.column} {'=' if r.test == '==' else r.test} {value}"
    return f"CASE WHEN {test} THEN 1 ELSE 0 END AS {r.flag}"


def logit(model: Model) -> str:
    return " + ".join(
        [f"{model.intercept}::DOUBLE", *[f"{c} * {b:.12f}::DOUBLE" for c, b in model.betas.items()]]
    )


def bin_sql(diff: str, breaks) -> str:
    arms = " ".join(f"WHEN {diff} <= {b} THEN {5 * (i + 1)}" for i, b in enumerate(breaks))
    return f"CASE WHEN {diff} IS NULL THEN 0 {arms} ELSE 100 END"


def step_sql(p: str, steps, last: float) -> str:
    arms = " ".join(f"WHEN {p} <= {top} THEN {value}" for top, value in steps)
    return f"CASE {arms} ELSE {last} END::DOUBLE"


def letter_sql(p: str) -> str:
    return (
        f"CASE WHEN {p} IS NULL THEN 'N/A' WHEN {p} >= 90 THEN 'E' WHEN {p} >= 75 THEN 'D' "
        f"WHEN {p} >= 25 THEN 'C' WHEN {p} >= 10 THEN 'B' ELSE 'A' END"
    )


CERT_NAMES = {k: v for k, v in HEADERS["certifications"].items() if k not in ("ccn", "day", "updated")}
SHARES = {
    "def": "def_binary",
    "alleg": "alleg_binary",
    "sub_alleg": "sub_alleg_bin",
    "rehosp_alleg": "rehosp_bin",
    "comp_bin": "comp_binary",
}

def title_sql(c: str) -> str:
    """Capital after a blank, an apostrophe, a hyphen or a hash; enough for the derived names."""
    word = "upper(substr({w}, 1, 1)) || lower(substr({w}, 2))"
    inner = word.format(w="u")
    for sep in ("-", "''", "#", " "):
        var = "t" + str(ord(sep[0]))
        inner = (
            f"list_reduce(list_transform(string_split({var if sep != ' ' else c}, '{sep}'), "
            f"lambda {'u' if sep == '-' else prev}: {inner}), lambda a, b: a || '{sep}' || b)"
        )
        prev = var
    return inner


def scorecard_ctes() -> str:
    m = [x.name for x in MEASURES]
    flags = ", ".join(rule_sql(r) for r in rules.RULES)
    service_match = " AND ".join(f"s.{x} = q.{x}" for x in SERVICES)
    logits = ", ".join(
        f"{logit(spec.worst)} AS worst_{o}, {logit(spec.best)} AS best_{o}" for o, spec in OUTCOMES.items()
    )
    diffs = ", ".join(
        f"1.0::DOUBLE / (1.0::DOUBLE + exp(-best_{o})) - 1.0::DOUBLE / (1.0::DOUBLE + exp(-worst_{o})) AS diff_{o}"
        for o in OUTCOMES
    )
    bins = ", ".join(f"{bin_sql(f'diff_{o}', s.breaks)} AS bin_{o}" for o, s in OUTCOMES.items())
    shrunk = ", ".join(
        f"CASE WHEN {s.small_flag} = 1 THEN 25 + bin_{o} / 2.0::DOUBLE ELSE bin_{o} END AS oe_{o}"
        for o, s in OUTCOMES.items()
    )
    estimates = ", ".join(
        f"{step_sql(f'oe_{o}', s.steps, s.last_step)} AS est_{o}" for o, s in OUTCOMES.items()
    )
    stats = ", ".join(
        [f"median(est_{o}) OVER (PARTITION BY state) AS median_{o}" for o in OUTCOMES]
        + [f"round_even({rank_sql(x.name, 'state')}, 0) AS {x.state_rank}" for x in MEASURES]
        + [
            f"CASE WHEN county_count >= 40 THEN round_even({rank_sql(x.name, 'county_id')}, 0) END AS {x.county_rank}"
            for x in MEASURES
        ]
        + [
            f"coalesce(sum({c}) OVER (PARTITION BY {k}), 0) / count(*) OVER (PARTITION BY {k}) AS {n}_{e}_mean"
            for n, c in SHARES.items()
            for k, e in (("state", "state"), ("county_id", "county"))
        ]
        + [
            f"coalesce(sum({c}) OVER (PARTITION BY state), 0) AS {n}_sum" for n, c in SHARES.items()
        ]
        + [f"{rank_sql(f'diff_{o}', 'state')} AS ptile_{o}" for o in OUTCOMES]
    )
    letters = ", ".join(
        f"CASE WHEN {s.small_flag} = 1 AND l_{o} = 'E' THEN 'D' WHEN {s.small_flag} = 1 AND l_{o} = 'A' "
        f"THEN 'B' ELSE l_{o} END AS {s.letter}"
        for o, s in OUTCOMES.items()
    )
    raw_letters = ", ".join(f"{letter_sql(f'ptile_{o}')} AS l_{o}" for o in OUTCOMES)
    rates = ", ".join(
        f"avg(est_{o}) OVER (PARTITION BY {s.letter}) * {s.letter_base}::DOUBLE AS {s.rates}_comp_rate, "
        f"median_{o} * {s.state_base}::DOUBLE AS {s.rates}_state_rate"
        for o, s in OUTCOMES.items()
    )
    survey_numbers = ", ".join(f"TRY_CAST(s.{x.name} AS DOUBLE) AS {x.name}" for x in SURVEY)
    defs = [c for c in TAG_RUNS]
    return f"""{SUMMARY},
{ALLEGATIONS},
{CERTIFICATIONS},
{AREA},
{BENCHMARK},
{ctes('quality_measures')},
joined AS (
    SELECT r.county_id, r.id, r.state, r.county, r.zip, r.county_count, b.state AS bench_state, b.rate_adj,
           strftime(c.d, '%Y%m%d') AS cert_day, c.updated,
           {', '.join(f'c.{k} AS {v}' for k, v in CERT_NAMES.items())}, {', '.join('c.' + x for x in YEARLY)},
           {', '.join(f'coalesce(c.{x}, 0) AS {x}' for x in rules.SMALL_LIMITS)},
           q.name, q.address, q.ownership, q.certified, q.stars, q.readmitted, q.emergency,
           {', '.join('q.' + x.name for x in QUALITY)},
           s.city, s.stars AS survey_stars, s.surveys, s.response, {survey_numbers},
           d.def_total, {', '.join('d.' + x for x in defs)}, d.lastsurv, d.complaint,
           CASE WHEN d.id IS NULL THEN NULL WHEN d.complaint IS NULL THEN 0 ELSE 1 END AS comp_binary,
           CASE WHEN d.id IS NOT NULL THEN 1 END AS def_binary,
           a.alleg_total, a.total_sub_alleg, a.total_rehosp_alleg, a.sub_alleg_bin, a.rehosp_bin,
           a.weight_flag, a.total_weight_alleg
    FROM area r
    LEFT JOIN certification c ON c.id = r.id
    LEFT JOIN benchmark b ON b.state = r.state
    LEFT JOIN quality_measures q ON {pad('q.ccn', 6)} = r.id AND q.state = r.state
    LEFT JOIN patient_survey s ON {pad('s.ccn', 6)} = r.id AND s.state = r.state AND {service_match}
    LEFT JOIN deficiency d ON d.id = r.id AND d.state = r.state
    LEFT JOIN allegation a ON a.id = r.id),
averaged AS (
    SELECT *, (m_qm_flu_shot + m_qm_pneum_shot) / 2 AS qm_immun_shots,
           (m_qm_improv_mobil + m_qm_improv_trans + m_qm_bathing + m_qm_pain_moving) / 4 AS qm_func_status_avg,
           HHA_AIDE_CNT / nullif(RN_CNT + LPN_LVN_CNT, 0) AS aide_over_tot_licensed
    FROM joined),
flagged AS (SELECT *, {flags} FROM averaged),
scored AS (SELECT *, {logits} FROM flagged),
differing AS (SELECT *, {diffs} FROM scored),
binned AS (SELECT *, {bins} FROM differing),
shrunk AS (SELECT *, {shrunk} FROM binned),
estimated AS (SELECT *, {estimates} FROM shrunk),
ranked AS (SELECT *, {stats} FROM estimated),
lettered AS (SELECT *, {raw_letters} FROM ranked),
clamped AS (SELECT *, {letters} FROM lettered),
rated AS (SELECT *, {rates} FROM clamped)"""


def not_provided(c: str) -> str:
    return f"CASE WHEN {c} = 'NOT PROVIDED' THEN 'No' ELSE 'Yes' END"


def compared(c: str) -> str:
    return f"CASE left({c}, 4) WHEN 'Wors' THEN 'D' WHEN 'Same' THEN 'C' WHEN 'Bett' THEN 'A' ELSE 'N/A' END"


TEXTS = {
    "CMS_ID": "'''' || id",
    "Ecosystem_Name": "county_id",
    "provider_name": title_sql("replace(name, ',', ' ')"),
    "address": "upper(replace(address, ',', ' '))",
    "city": "upper(city)",
    "state": "state",
    "zip_code": "zip",
    "county": "county",
    "State_Srv": "bench_state",
    "Ownership_Type": """CASE WHEN ownership LIKE '%Proprietary%' THEN 'For-Profit'
        WHEN ownership LIKE '%Government%' THEN 'Government'
        WHEN ownership LIKE '%Non - Profit%' THEN 'Non-Profit' ELSE 'N/A' END""",
    "Lab_Service_Binary": not_provided("LAB_SRVC_DESC"),
    "Pharm_Service_Binary": not_provided("PHRMCY_SRVC_DESC"),
    "Nursing_Service_Binary": not_provided("NRSNG_SRVC_DESC"),
    "PT_Service_Binary": not_provided("PT_SRVC_DESC"),
    "OT_Service_Binary": not_provided("OCPTNL_THRPST_SRVC_DESC"),
    "Speech_Service_Binary": not_provided("SPCH_THRPY_SRVC_DESC"),
    "Med_SS_Service_Binary": not_provided("MDCL_SCL_SRVC_DESC"),
    "HH_Aide_Service_Binary": not_provided("HH_AIDE_SRVC_DESC"),
    "date_certified": "certified",
    "quality_of_patient_care_star_rating": "coalesce(CAST(stars AS VARCHAR), 'N/A')",
    "hhcahps_survey_summary_star_rating": "survey_stars",
    "qm_hosp_admit_ptile_rank": letter_sql("qm_admit_hosp_county_ptile"),
    "qm_urgent_care_no_hosp_rank": letter_sql("qm_urgent_care_norehosp_county_ptile"),
    READMITTED_HEADER: "readmitted",
    "qm_pac_hosp_admitt_rank": compared("readmitted"),
    EMERGENCY_HEADER: "emergency",
    "qm_pac_urgent_care_no_hosp_rank": compared("emergency"),
    "m_hcaps_discuss_med": "coalesce(CAST(m_hcaps_discuss_med / 100 AS VARCHAR), 'N/A')",
    "m_hcaps_communicated": "coalesce(CAST(m_hcaps_communicated / 100 AS VARCHAR), 'N/A')",
    "m_qm_admit_hosp": "coalesce(CAST(m_qm_admit_hosp / 100 AS VARCHAR), 'N/A')",
    "number_of_completed_surveys": "surveys",
    "response_rate": "response",
    "CRTFCTN_DT": "cert_day",
    "CRTFCTN_UPDT_DT": "updated",
    "Reporting_Month": f"'{ASOF[:4]}/{ASOF[5:7]}'",
    **{s.letter: s.letter for s in OUTCOMES.values()},
}
NUMBERS = {
    "County_count": "county_count",
    "def_total": "coalesce(def_total, 0)",
    "alleg_total": "coalesce(alleg_total, 0)",
    "tagcount_lastsurv": "coalesce(lastsurv, 0)",
    "tagcount_complaint": "coalesce(complaint, 0)",
    **{x.name: f"{x.name} / 100" for x in MEASURES if x.name not in TEXTS},
}


# Measure behind each published header.
PUBLISHED = {
    "how_often_the_home_health_team_began_their_patients’_care_in_a_timely_manner": "m_qm_timely_manner",
    "how_often_the_home_health_team_taught_patients_or_their_family_caregivers_about_their_drugs": "m_qm_teach_drugs",
    "how_often_the_home_health_team_checked_patients’_risk_of_falling": "m_qm_risk_falling",
    "how_often_the_home_health_team_checked_patients_for_depression": "m_qm_depression",
    "how_often_the_home_health_team_determined_whether_patients_received_a_flu_shot_for_the_currnet_flu_season": "m_qm_flu_shot",
    "how_often_the_home_health_team_made_sure_that_their_patients_have_received_a_pneumococcal_vaccine_pneumonia_shot": "m_qm_pneum_shot",
    "with_diabetes_how_often_the_home_health_team_got_doctor’s_orders_gave_foot_care_and_taught_patients_about_foot_care": "m_qm_diabetes_footcare",
    "how_often_patients_got_better_at_walking_or_moving_around": "m_qm_improv_mobil",
    "how_often_patients_got_better_at_getting_in_and_out_of_bed": "m_qm_improv_trans",
    "how_often_patients_got_better_at_bathing": "m_qm_bathing",
    "how_often_patients_had_less_pain_when_moving_around": "m_qm_pain_moving",
    "how_often_patients’_breathing_improved": "m_qm_breathing",
    "how_often_patients’_wounds_improved_or_healed_after_an_operation": "m_qm_improv_wounds",
    "how_often_patients_got_better_at_taking_their_drugs_correctly_by_mouth": "m_qm_correct_meds",
    "how_often_home_health_patients_had_to_be_admitted_to_the_hospital": "m_qm_admit_hosp",
    "how_often_patients_receiving_home_health_care_needed_urgent_unplanned_care_in_the_er_without_being_admitted": "m_qm_urgent_care_no_hosp",
    "percent_of_patients_who_reported_that_their_home_health_team_gave_care_in_a_professional_way": "m_hcaps_prof_care",
    "percent_of_patients_who_reported_that_their_home_health_team_communicated_well_with_them": "m_hcaps_communicated",
    "percent_of_patients_who_reported_that_their_home_health_team_discussed_medicines_pain_and_home_safety_with_them": "m_hcaps_discuss_med",
    "percent_of_patients_who_gave_their_home_health_agency_a_rating_of_9_or_10_on_a_scale_from_0_lowest_to_10_highest": "m_hcaps_above_8",
    "percent_of_patients_who_reported_yes_they_would_definitely_recommend_the_home_health_agency_to_friends_and_family": "m_hcaps_definitely_recommend",
}


def scorecard_table(columns: list[str]) -> str:
    inner = [(c, PUBLISHED.get(c, c)) for c in columns]
    shown = [
        f'{TEXTS[i]} AS "{c}"' if i in TEXTS else num(NUMBERS.get(i, i), c) for c, i in inner
    ]
    return f"WITH {scorecard_ctes()}\nSELECT {', '.join(shown)} FROM rated"
