"""Scoring operators on line items and customers."""

from __future__ import annotations

from gradewell.functions import flags, scoring
from gradewell.functions.dates import gap_days
from gradewell.operators import groups, joins, ranks
from gradewell.plans.allegations import finding_weight
from gradewell.plans.certifications import per_year, survey_gap
from gradewell.plans.scorecard import attach_letter_means
from gradewell.specs.models import OUTCOMES
from gradewell.specs.rules import SMALL_LIMITS
from pyspark.sql import functions as F
from querybook.groups import rank_sql
from querybook.tools import day, load, register, six

QUERIES: dict = {}
SQL: dict[str, str] = {}

WORST = {"l_quantity": 0.04, "l_discount": -6.0, "l_tax": 5.0, "returned": 0.3}
BEST = {"l_quantity": -0.03, "l_discount": 7.0, "l_tax": -4.0, "returned": -0.2}
MED = OUTCOMES["med"]

LINES_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
    -0.9 + 0.04 * l_quantity - 6.0 * l_discount + 5.0 * l_tax
      + 0.3 * (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS z_worst,
    0.6 - 0.03 * l_quantity + 7.0 * l_discount - 4.0 * l_tax
      - 0.2 * (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS z_best FROM lineitem"""
DIFF_SQL = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
    CASE WHEN l_quantity <> 50
         THEN round(1 / (1 + exp(-z_best)) - 1 / (1 + exp(-z_worst)), 6) END AS diff
    FROM ({LINES_SQL})"""
# The label is 5 times one more than the number of breaks below the value.
BIN_SQL = f"""SELECT *, CASE WHEN diff IS NULL THEN 0.0::DOUBLE ELSE
    5.0::DOUBLE * (1 + len(list_filter({[float(b) for b in MED.breaks]}::DOUBLE[], lambda b: b < diff))) END AS bin
    FROM ({DIFF_SQL})"""
SHRINK_SQL = f"""SELECT *, CASE WHEN l_quantity < 5 THEN bin / 2 + 25 ELSE bin END AS ptile
    FROM ({BIN_SQL})"""
STEPS_SQL = "CASE " + " ".join(
    f"WHEN ptile > {low} THEN {value}"
    for low, value in reversed(
        list(zip([-1] + [top for top, _ in MED.steps], [v for _, v in MED.steps] + [MED.last_step]))
    )
) + " END::DOUBLE"
LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def lines(spark, folder):
    returned = flags.flag(F.col("l_returnflag") == "R")
    base = load(spark, folder, "lineitem").withColumn("returned", returned)
    return base.withColumns(
        {
            "z_worst": scoring.linear_score(WORST, -0.9),
            "z_best": scoring.linear_score(BEST, 0.6),
        }
    )


def keyed(df, *cols):
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *cols)


def differences(spark, folder):
    diff = scoring.logistic("z_best") - scoring.logistic("z_worst")
    known = F.when(F.col("l_quantity") != 50, F.round(diff, 6))
    return lines(spark, folder).withColumn("diff", known)


def binned(spark, folder):
    return differences(spark, folder).withColumn("bin", scoring.bin_by("diff", MED.breaks))


def shrunk(spark, folder):
    small = flags.flag(F.col("l_quantity") < 5)
    with_flag = binned(spark, folder).withColumn("small", small)
    return with_flag.withColumn("ptile", scoring.shrink("bin", "small"))


@register(
    QUERIES,
    SQL,
    f"SELECT {LINE}, round(z_worst, 6) AS z_worst, round(z_best, 6) AS z_best FROM ({LINES_SQL})",
)
def linear_score(spark, folder):
    return keyed(
        lines(spark, folder), six("z_worst").alias("z_worst"), six("z_best").alias("z_best")
    )


@register(
    QUERIES,
    SQL,
    f"""SELECT {LINE}, round(1 / (1 + exp(-z_worst)), 6) AS worst, round(1 / (1 + exp(-z_best)), 6) AS best
        FROM ({LINES_SQL})""",
)
def logistic_score(spark, folder):
    return keyed(
        lines(spark, folder),
        six(scoring.logistic("z_worst")).alias("worst"),
        six(scoring.logistic("z_best")).alias("best"),
    )


@register(QUERIES, SQL, f"SELECT {LINE}, diff FROM ({DIFF_SQL})")
def score_diff(spark, folder):
    return keyed(differences(spark, folder), "diff")


@register(QUERIES, SQL, f"SELECT {LINE}, bin FROM ({BIN_SQL})")
def bin20(spark, folder):
    return keyed(binned(spark, folder), "bin")


@register(QUERIES, SQL, f"SELECT {LINE}, ptile FROM ({SHRINK_SQL})")
def shrink_ptile(spark, folder):
    return keyed(shrunk(spark, folder), "ptile")


@register(QUERIES, SQL, f"SELECT {LINE}, {STEPS_SQL} AS estimate FROM ({SHRINK_SQL})")
def step_estimate(spark, folder):
    estimate = scoring.step_map("ptile", MED.steps, MED.last_step)
    return keyed(shrunk(spark, folder), estimate.alias("estimate"))


PTILE_SQL = f"""SELECT c_custkey, c_acctbal, coalesce(n, 0) AS n_orders,
    round({rank_sql('c_acctbal', 'c_nationkey')}, 6) AS ptile
    FROM (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
                 (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer)"""
LETTER_SQL = f"""SELECT *, CASE WHEN ptile IS NULL THEN 'N/A' WHEN ptile >= 90 THEN 'E'
    WHEN ptile >= 75 THEN 'D' WHEN ptile >= 25 THEN 'C' WHEN ptile >= 10 THEN 'B' ELSE 'A' END AS letter
    FROM ({PTILE_SQL})"""
CLAMP_SQL = f"""SELECT *, CASE WHEN n_orders < 8 AND letter = 'A' THEN 'B'
    WHEN n_orders < 8 AND letter = 'E' THEN 'D' ELSE letter END AS clamped FROM ({LETTER_SQL})"""
MEAN_SQL = f"""SELECT *, avg(c_acctbal) OVER (PARTITION BY clamped) AS mean_bal FROM ({CLAMP_SQL})"""


def lettered(spark, folder):
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    customer = load(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", balance.alias("c_acctbal")
    )
    per_customer = groups.group_count(
        load(spark, folder, "orders"), ["o_custkey"], "o_orderkey", "n_orders"
    ).withColumnRenamed("o_custkey", "c_custkey")
    rows = joins.lookup_join(customer, per_customer, ["c_custkey"]).na.fill(0, ["n_orders"])
    ranked = ranks.attach_pct_rank(
        rows, ["c_nationkey"], {"raw": "c_acctbal"}, rounded=False
    ).withColumn("ptile", six("raw"))
    return ranked.withColumns(
        {
            "letter": scoring.letter_grade("ptile"),
            "small": flags.flag(F.col("n_orders") < 8),
        }
    ).withColumn("clamped", scoring.clamp_letter("letter", "small"))


@register(QUERIES, SQL, f"SELECT c_custkey, ptile, letter FROM ({LETTER_SQL})")
def letter_grade(spark, folder):
    return lettered(spark, folder).select("c_custkey", "ptile", "letter")


@register(QUERIES, SQL, f"SELECT c_custkey, n_orders, letter, clamped FROM ({CLAMP_SQL})")
def clamp_letter(spark, folder):
    return lettered(spark, folder).select("c_custkey", "n_orders", "letter", "clamped")


@register(
    QUERIES, SQL, f"SELECT c_custkey, clamped, round(mean_bal, 4) AS mean_bal FROM ({MEAN_SQL})"
)
def letter_mean(spark, folder):
    out = attach_letter_means(lettered(spark, folder), {"mean_bal": ("clamped", "c_acctbal")})
    return out.select("c_custkey", "clamped", F.round("mean_bal", 4).alias("mean_bal"))


@register(
    QUERIES, SQL, f"SELECT c_custkey, round(mean_bal * 0.147237, 4) AS rate FROM ({MEAN_SQL})"
)
def scaled_rate(spark, folder):
    out = attach_letter_means(lettered(spark, folder), {"mean_bal": ("clamped", "c_acctbal")})
    base = OUTCOMES["all"].letter_base
    return out.select("c_custkey", F.round(F.col("mean_bal") * F.lit(base), 4).alias("rate"))


@register(
    QUERIES,
    SQL,
    """SELECT l_orderkey, l_linenumber,
              CAST(sum(greatest(3 - l_linenumber, 0)) OVER (PARTITION BY l_orderkey, l_linenumber) AS BIGINT)
                AS by_finding,
              CAST(sum(greatest(3 - l_linenumber, 0)) OVER (PARTITION BY l_orderkey) AS BIGINT) AS by_order
       FROM lineitem""",
)
def weighted_findings(spark, folder):
    rows = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    rows = rows.withColumn("weight", finding_weight("l_linenumber"))
    levels = {"by_finding": ["l_orderkey", "l_linenumber"], "by_order": ["l_orderkey"]}
    out = groups.attach_sums(rows, levels, "weight")
    return out.drop("weight")


ANNUAL_SQL = """SELECT o_orderkey, o_totalprice / nullif(days / 365.0, 0) AS per_year, days FROM (
    SELECT o_orderkey, o_totalprice,
           CASE WHEN d - d1 = 1 OR (d - d1 >= 1 AND d - d1 <= 100 AND o_totalprice > 100000)
                THEN d - d2 ELSE d - d1 END AS days
    FROM (SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS d,
                 CAST(lag(o_orderdate, 1) OVER w AS DATE) AS d1,
                 CAST(lag(o_orderdate, 2) OVER w AS DATE) AS d2
          FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)))"""


def annual(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", day("o_orderdate").alias("d")
    )
    lagged = ranks.attach_lag(
        orders, "o_custkey", ["d", "o_orderkey"], {"d1": ("d", 1), "d2": ("d", 2)}
    )
    days = survey_gap(gap_days("d", "d1"), gap_days("d", "d2"), "o_totalprice", 100000)
    counted = lagged.withColumn("days", days)
    return counted.withColumn("per_year", per_year("o_totalprice", "days"))


@register(
    QUERIES,
    SQL,
    f"SELECT o_orderkey, CAST(days AS DOUBLE) AS days, round(per_year, 3) AS per_year FROM ({ANNUAL_SQL})",
)
def annualized_rate(spark, folder):
    return annual(spark, folder).select(
        "o_orderkey", F.col("days").cast("double").alias("days"), F.round("per_year", 3).alias("per_year")
    )


@register(
    QUERIES,
    SQL,
    "SELECT o_orderkey, "
    + ", ".join(
        f"CASE WHEN per_year / 10000 < {limit} THEN 1 ELSE 0 END AS {name}"
        for name, limit in SMALL_LIMITS.items()
    )
    + f" FROM ({ANNUAL_SQL})",
)
def small_volume_flags(spark, folder):
    scaled = annual(spark, folder).withColumn("v", F.col("per_year") / 10000)
    return scaled.withColumns(flags.below_flags("v", SMALL_LIMITS)).select(
        "o_orderkey", *SMALL_LIMITS
    )
