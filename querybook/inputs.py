"""Input tables of the jobs, derived from the given tables.

Each is one SQL text that Spark and the comparing engine both understand, so the
two sides start from equal rows; everything after that is written twice. Raw
headers, binary columns and the like are put on afterwards, on the Spark side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewell.plans.scorecard import EMERGENCY_HEADER, READMITTED_HEADER, SERVICES
from gradewell.specs.measures import MEASURES, QUALITY, SURVEY
from querybook.tools import load

ASOF = "2001-08-01"
STATES = ("AZ", "CA", "FL", "NV", "MD", "TX", "NY")


def pick(number: str, values) -> str:
    """CASE over ``number`` modulo the number of values."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {cases} END"


STATE = pick("c_custkey", STATES)
CARE = ("PROVIDED BY STAFF", "NOT PROVIDED", "UNDER ARRANGEMENT")
SERVICE_COLUMNS = ", ".join(
    f"CASE WHEN c_custkey % {i + 5} = 0 THEN 'No' ELSE 'Yes' END AS {s}"
    for i, s in enumerate(SERVICES)
)
QUALITY_COLUMNS = ", ".join(
    f"CASE WHEN (c_custkey + {i}) % 19 = 0 THEN NULL"
    f" ELSE CAST((c_custkey * {2 * i + 7} + {i * 31}) % 101 AS DOUBLE) END AS {m.name}"
    for i, m in enumerate(QUALITY)
)
SURVEY_COLUMNS = ", ".join(
    f"CASE WHEN (c_custkey + {i}) % 17 = 0 THEN 'Not Available'"
    f" ELSE CAST((c_custkey * {2 * i + 23} + {i}) % 101 AS STRING) END AS {m.name}"
    for i, m in enumerate(SURVEY)
)
EXPECTED = ("Worse Than Expected", "Same As Expected", "Better Than Expected", "Not Available")

INPUTS: dict[str, str] = {
    "health_deficiencies": """
        SELECT CAST(o_custkey AS STRING) AS ccn, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
               CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'S' END AS cycle,
               CASE WHEN l_linenumber = 7 THEN NULL
                    ELSE CAST((l_partkey * 7 + l_linenumber) % 350 AS DOUBLE) END AS tag, 'G' AS prefix
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "complaint_surveys": """
        SELECT CAST(o_custkey AS STRING) AS ccn, CAST(CAST(l_shipdate AS DATE) AS STRING) AS day,
               CASE WHEN l_returnflag = 'N' THEN 'S' ELSE 'C' END AS cycle,
               CAST((l_partkey * 3) % 350 AS DOUBLE) AS tag, 'G' AS prefix
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "complaint_details": """
        SELECT CAST(o_custkey AS STRING) AS ccn, CAST(CAST(l_shipdate AS DATE) AS STRING) AS day,
               CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_partkey % 30 + 1 AS INT) END AS kind,
               CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_linenumber AS INT) END AS finding
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "certifications": f"""
        SELECT CAST(o_custkey AS STRING) AS ccn, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
               CAST(100000000 + o_orderkey AS STRING) AS updated,
               CAST(floor(o_totalprice / 150) AS BIGINT) AS admits, o_orderkey % 90 AS readmits,
               o_orderkey % 70 AS hospital, o_orderkey % 13 AS nursing, o_orderkey % 50 AS goal,
               o_orderkey % 7 AS died, o_orderkey % 300 AS discharged,
               CAST(o_orderkey % 12 AS DOUBLE) AS rn, CAST(o_orderkey % 4 AS DOUBLE) AS lpn,
               CAST(o_orderkey % 9 AS DOUBLE) AS aides,
               {pick('o_orderkey', ('PROPRIETARY', 'GOVERNMENT', 'OTHER'))} AS control,
               {pick('o_orderkey + 1', CARE)} AS lab, {pick('o_orderkey + 2', CARE)} AS pharmacy,
               {pick('o_custkey', CARE)} AS other,
               {pick('o_orderkey', ('MEDICARE ONLY', 'BOTH'))} AS program,
               {pick('o_orderkey', ('RN/LPN', 'PHYSICIAN', 'OTHER', 'NONE'))} AS admin,
               {pick('o_custkey + 1', CARE)} AS nursing_care, {pick('o_custkey + 2', CARE)} AS pt,
               {pick('o_orderkey', CARE)} AS ot, {pick('o_orderkey + o_custkey', CARE)} AS speech,
               {pick('o_custkey', CARE)} AS social, {pick('o_orderkey + 2 * o_custkey', CARE)} AS aide_care,
               {pick('o_orderkey + 1', CARE)} AS nutrition,
               {pick('o_custkey', ('CARE THAT PROMOTES POTENTIAL', 'OTHER'))} AS summary
        FROM orders""",
    "provider_zips": f"""
        SELECT DISTINCT {pick('o_custkey', STATES)} AS state, CAST(o_custkey AS STRING) AS ccn,
               CAST(o_orderkey % 997 + 501 AS STRING) AS zip FROM orders""",
    "zip_county": """
        SELECT DISTINCT CAST(o_orderkey % 997 + 501 AS STRING) AS zip,
               'County ' || CAST((o_orderkey % 997) % 41 AS STRING) AS county FROM orders
        UNION ALL
        SELECT DISTINCT CAST(o_orderkey % 997 + 501 AS STRING) AS zip,
               'County ' || CAST((o_orderkey % 997 + 3) % 41 AS STRING) AS county FROM orders
        WHERE (o_orderkey % 997) % 5 = 0""",
    "facility_rates": """
        SELECT CAST(s_suppkey AS STRING) AS ccn, (s_suppkey % 100) / 1000 AS rate FROM supplier""",
    "facilities_monthly": f"""
        SELECT CAST(CASE WHEN l_suppkey % 10 = 9 THEN -l_suppkey ELSE l_suppkey END AS STRING) AS ccn,
               CAST(l_shipdate AS DATE) AS day,
               {pick('l_suppkey', STATES)} AS state FROM lineitem""",
    "quality_measures": f"""
        SELECT CAST(CASE WHEN c_custkey % 29 = 0 THEN -c_custkey ELSE c_custkey END AS STRING) AS ccn,
               {STATE} AS state, 'qtown' AS city,
               CASE WHEN c_custkey % 3 = 0 THEN 'O''NEIL CARE, ' ELSE 'first-home ' END || c_name AS name,
               CAST(c_custkey AS STRING) || ' main st, suite b' AS address,
               {pick('c_custkey', ('Voluntary Non - Profit', 'Government - State', 'Proprietary', 'Other'))}
                 AS ownership,
               '19' || CAST(80 + c_custkey % 20 AS STRING) || '-01-01' AS certified, {SERVICE_COLUMNS},
               CASE WHEN c_custkey % 23 = 0 THEN NULL
                    ELSE CAST(c_custkey % 9 AS DOUBLE) / 2 + 1 END AS stars,
               {pick('c_custkey', EXPECTED)} AS readmitted, {pick('c_custkey + 1', EXPECTED)} AS emergency,
               {QUALITY_COLUMNS}
        FROM customer""",
    "patient_survey": f"""
        SELECT CAST(CASE WHEN c_custkey % 31 = 0 THEN -c_custkey ELSE c_custkey END AS STRING) AS ccn,
               {STATE} AS state, 'san ' || c_mktsegment AS city,
               c_name AS name, CAST(c_custkey AS STRING) || ' side st' AS address,
               CAST(c_custkey % 997 + 501 AS STRING) AS zip, {SERVICE_COLUMNS},
               CAST(c_custkey % 5 + 1 AS STRING) AS stars, CAST(c_custkey % 400 AS STRING) AS surveys,
               CAST(c_custkey % 60 AS STRING) AS response, {SURVEY_COLUMNS}
        FROM customer""",
}

# Header of each derived column in the job's input table (fixed values).
CCN_HEADER = "CMS Certification Number (CCN)"
HEADERS: dict[str, dict[str, str]] = {
    "health_deficiencies": {
        "ccn": "PRVDR_CCN",
        "day": "CLNDR_SRVY_DT_SK",
        "cycle": "SRVY_CYC_CD",
        "tag": "TAG_NUM",
        "prefix": "PREX_CD",
    },
    "complaint_surveys": {
        "ccn": "PRVDR_CCN",
        "day": "CLNDR_SRVY_DT_SK_10",
        "cycle": "SRVY_CYC_CD_4",
        "tag": "TAG_NUM_15",
        "prefix": "PREX_CD_16",
    },
    "complaint_details": {
        "ccn": "PRVDR_CCN",
        "day": "CLNDR_EXIT_DT_SK",
        "kind": "ALGTN_TYPE_CD",
        "finding": "ALGTN_FNDNG_CD",
    },
    "certifications": {
        "ccn": "PRVDR_CCN",
        "day": "CLNDR_CRTFCTN_DT_SK",
        "updated": "CLNDR_CRTFCTN_UPDT_DT_SK",
        "admits": "CNSUS_ADMSN_UNDUPD_CNT",
        "readmits": "CNSUS_ADMSN_READMSN_CNT",
        "hospital": "CNSUS_HOSP_DSCHRG_CNT",
        "nursing": "NH_DSCHRG_CNT",
        "goal": "CNSUS_DSCHRG_GOAL_MET_CNT",
        "died": "CNSUS_DEATH_DSCHRG_CNT",
        "discharged": "DSCHRG_CNT",
        "rn": "RN_CNT",
        "lpn": "LPN_LVN_CNT",
        "aides": "HHA_AIDE_CNT",
        "control": "GNRL_CNTL_TYPE_DESC",
        "lab": "LAB_SRVC_DESC",
        "pharmacy": "PHRMCY_SRVC_DESC",
        "other": "OTHR_SRVC_DESC",
        "program": "PGM_PRTCPTN_DESC",
        "admin": "DSCPLN_ADMINR_DESC",
        "nursing_care": "NRSNG_SRVC_DESC",
        "pt": "PT_SRVC_DESC",
        "ot": "OCPTNL_THRPST_SRVC_DESC",
        "speech": "SPCH_THRPY_SRVC_DESC",
        "social": "MDCL_SCL_SRVC_DESC",
        "aide_care": "HH_AIDE_SRVC_DESC",
        "nutrition": "NTRTNL_GDNC_SRVC_DESC",
        "summary": "SRVYR_SMRY_DESC",
    },
    "provider_zips": {"ccn": "cms_certification_number_ccn", "zip": "zip_code"},
    "zip_county": {"zip": "zip_code"},
    "facility_rates": {"ccn": "CCN", "rate": "rate_adj"},
    "facilities_monthly": {"ccn": "PROV_NUM", "day": "Survey_date", "state": "STATE_ABBREV"},
    "quality_measures": {
        "ccn": CCN_HEADER,
        "state": "State",
        "city": "City",
        "name": "Provider Name",
        "address": "Address",
        "ownership": "Type of Ownership",
        "certified": "Date Certified",
        "stars": "Quality of Patient Care Star Rating",
        "readmitted": READMITTED_HEADER,
        "emergency": EMERGENCY_HEADER,
    },
    "patient_survey": {
        "ccn": CCN_HEADER,
        "state": "State",
        "city": "City",
        "name": "Provider Name",
        "address": "Address",
        "zip": "Zip",
        "stars": "HHCAHPS Survey Summary Star Rating",
        "surveys": "Number of Completed Surveys",
        "response": "Response Rate",
    },
}


def ctes(*names: str) -> str:
    return ",\n".join(f"{n} AS ({INPUTS[n]})" for n in names)


def derived(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One job input, under the headers the job expects."""
    text = INPUTS[name]
    used = {t: load(spark, folder, t) for t in ("lineitem", "orders", "customer", "supplier")}
    used = {t: df for t, df in used.items() if re.search(rf"\b{t}\b", text)}
    text = re.sub(r"\b(FROM|JOIN) (\w+)", r"\1 {\2}", text)
    df = spark.sql(text, **used)
    headers = dict(HEADERS[name])
    headers |= {m.name: m.header for m in MEASURES}
    headers |= {s: s.replace("_", " ").title() for s in SERVICES}
    df = df.withColumnsRenamed(headers)
    if name in ("quality_measures", "patient_survey"):
        df = df.withColumn("Footnote for city", F.lit("-"))
    if name == "certifications":
        df = df.withColumn("STATE_NAME", F.lit("-"))
    if name == "facility_rates":
        df = df.withColumn("CCN", F.encode("CCN", "UTF-8"))
    if name == "facilities_monthly":
        df = df.withColumns(
            {
                "PROV_NUM": F.encode("PROV_NUM", "UTF-8"),
                "STATE_ABBREV": F.encode("STATE_ABBREV", "UTF-8"),
            }
        )
    return df


def derived_tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {n: derived(spark, folder, n) for n in names or INPUTS}
