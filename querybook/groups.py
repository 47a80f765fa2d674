"""Aggregates, attached group values, ranks and lags."""

from __future__ import annotations

from gradewell.functions.dates import gap_days, gap_years
from gradewell.operators import groups, ranks
from gradewell.plans import profile
from pyspark.sql import functions as F
from querybook.tools import day, iso, load, register, six

QUERIES: dict = {}
SQL: dict[str, str] = {}

# Thirteen runs of part sizes; sizes 49 and 50 are in no list.
SIZE_RUNS = [
    (1, 4), (5, 6), (7, 12), (13, 14), (15, 18), (19, 21), (22, 26),
    (27, 29), (30, 32), (33, 39), (40, 42), (43, 45), (46, 48),
]
SIZE_LISTS = {f"sizes_{a}_{b}": list(range(a, b + 1)) for a, b in SIZE_RUNS}


@register(
    QUERIES,
    SQL,
    "SELECT c_nationkey, round(avg(c_acctbal), 6) AS mean_bal FROM customer GROUP BY 1",
)
def group_mean(spark, folder):
    out = groups.group_mean(load(spark, folder, "customer"), ["c_nationkey"], "c_acctbal", "mean_bal")
    return out.withColumn("mean_bal", six("mean_bal"))


@register(
    QUERIES,
    SQL,
    """SELECT o_custkey, count(CASE WHEN o_orderpriority <> '5-LOW' THEN 1 END) AS n
       FROM orders GROUP BY 1""",
)
def group_count(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p")
    )
    return groups.group_count(orders, ["o_custkey"], "p", "n")


@register(
    QUERIES,
    SQL,
    "SELECT o_custkey, "
    + ", ".join(
        f"count(*) FILTER (WHERE p_size BETWEEN {a} AND {b}) AS sizes_{a}_{b}" for a, b in SIZE_RUNS
    )
    + """ FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
         GROUP BY 1""",
)
def category_counts(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    part = load(spark, folder, "part").select("p_partkey", "p_size")
    rows = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return groups.category_counts(rows, ["o_custkey"], "p_size", SIZE_LISTS)


@register(
    QUERIES,
    SQL,
    """SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS lines,
              sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END)::BIGINT AS first_lines,
              sum(CASE WHEN l_linenumber <= 3 THEN 1 ELSE 0 END)::BIGINT AS low_lines,
              sum(CASE WHEN l_linenumber BETWEEN 4 AND 6 THEN 1 ELSE 0 END)::BIGINT AS mid_lines,
              count(l_linenumber) AS all_lines
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def flag_totals(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    number = F.col("l_linenumber")
    tests = {
        "first_lines": number.isin(1),
        "low_lines": number.isin(1, 2, 3),
        "mid_lines": number.isin(4, 5, 6),
        "all_lines": number.isNotNull(),
    }
    out = groups.flag_totals(rows, ["o_custkey", "o_orderdate"], tests, "lines")
    return out.withColumn("o_orderdate", iso("o_orderdate")).withColumnRenamed("o_orderdate", "day")


def encounters(spark, folder):
    """Encounter rows out of the events table, dates as the text the profile expects."""
    return load(spark, folder, "events").select(
        F.col("event_type").alias("EncType"),
        F.concat(F.lit("S"), F.col("user_id") % 3).alias("Admitting_Source"),
        F.concat(F.lit("D"), F.col("user_id") % 5).alias("Discharge_Disposition"),
        F.when(F.col("value") > 10, "H").alias("Discharge_Status"),
        F.date_format("ts", "MM/dd/yyyy").alias("ADate"),
        F.date_format("ts", "yyyy-MM-dd").alias("DDate"),
    )


PROFILE_SQL = """SELECT event_type AS "EncType", 'S' || CAST(user_id % 3 AS VARCHAR) AS "Admitting_Source",
        'D' || CAST(user_id % 5 AS VARCHAR) AS "Discharge_Disposition",
        CASE WHEN value > 10 THEN 'H' END AS "Discharge_Status",
        CAST(year(ts) AS VARCHAR) || '-' || CAST(month(ts) AS VARCHAR) AS "YearMonth",
        strftime(ts, '%Y-%m-%d') AS "DDate", count(*) AS "count"
     FROM events GROUP BY ALL"""


@register(QUERIES, SQL, PROFILE_SQL)
def encounter_profile(spark, folder):
    return profile.encounter_profile(encounters(spark, folder))


@register(
    QUERIES,
    SQL,
    """SELECT event_type AS "EncType", strftime(ts, '%Y-%m-%d') AS "DDate", count(*) AS "count"
       FROM events GROUP BY 1, 2""",
)
def encounter_rollup(spark, folder):
    return profile.encounter_rollup(profile.encounter_profile(encounters(spark, folder)))


def customers(spark, folder):
    return load(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")


@register(
    QUERIES,
    SQL,
    """SELECT c_custkey, count(CASE WHEN c_acctbal <= 9000 THEN 1 END)
              OVER (PARTITION BY c_nationkey) AS n FROM customer""",
)
def attach_count(spark, folder):
    known = customers(spark, folder).withColumn(
        "bal", F.when(F.col("c_acctbal") <= 9000, F.col("c_acctbal"))
    )
    out = groups.attach(known, ["c_nationkey"], {"n": F.count("bal")})
    return out.select("c_custkey", "n")


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey,
              sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)
                OVER (PARTITION BY o_custkey, o_orderstatus)::BIGINT AS urgent,
              round(coalesce(sum(CASE WHEN o_totalprice > 400000 THEN o_totalprice END)
                OVER (PARTITION BY o_custkey), 0), 2) AS big FROM orders""",
)
def attach_sum(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("u"),
        F.when(F.col("o_totalprice") > 400000, F.col("o_totalprice")).alias("b"),
    )
    out = groups.attach(orders, ["o_custkey", "o_orderstatus"], {"urgent": groups.total("u")})
    out = groups.attach(out, ["o_custkey"], {"big": F.round(groups.total("b"), 2)})
    return out.select("o_orderkey", "urgent", "big")


@register(
    QUERIES,
    SQL,
    """SELECT c_custkey, round(avg(c_acctbal) OVER (PARTITION BY c_nationkey), 6) AS mean_bal
       FROM customer""",
)
def attach_mean(spark, folder):
    means = {"mean_bal": six(F.avg("c_acctbal"))}
    return groups.attach(customers(spark, folder), ["c_nationkey"], means).select(
        "c_custkey", "mean_bal"
    )


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, round(median(o_totalprice) OVER (PARTITION BY o_orderstatus), 6) AS by_status,
              round(median(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS by_customer
       FROM orders""",
)
def attach_median(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    out = ranks.attach_median(orders, ["o_orderstatus"], {"by_status": "o_totalprice"})
    out = ranks.attach_median(out, ["o_custkey"], {"by_customer": "o_totalprice"})
    return out.select("o_orderkey", six("by_status").alias("by_status"), six("by_customer").alias("by_customer"))


def rank_sql(value: str, keys: str) -> str:
    """Average rank of ties over known values, times 100, in SQL."""
    return f"""CASE WHEN {value} IS NOT NULL THEN
        (rank() OVER (PARTITION BY {keys} ORDER BY {value} NULLS LAST)
          + count({value}) OVER (PARTITION BY {keys} ORDER BY {value} NULLS LAST)) / 2.0
        / count({value}) OVER (PARTITION BY {keys}) * 100.0 END"""


def ranked_customers(spark, folder):
    thousands = F.floor(F.col("c_acctbal") / 1000).cast("double")
    return customers(spark, folder).withColumns(
        {"tied": thousands, "holes": F.nullif(thousands, F.lit(0.0))}
    )


RANK_BASE = """SELECT c_custkey, c_nationkey, c_acctbal, floor(c_acctbal / 1000) AS tied,
                      nullif(floor(c_acctbal / 1000), 0) AS holes FROM customer"""
RANK_COLS = {"r_bal": "c_acctbal", "r_tied": "tied", "r_holes": "holes"}


@register(
    QUERIES,
    SQL,
    "SELECT c_custkey, "
    + ", ".join(f"round_even({rank_sql(c, 'c_nationkey')}, 0) AS {n}" for n, c in RANK_COLS.items())
    + f" FROM ({RANK_BASE})",
)
def pct_rank_avg(spark, folder):
    out = ranks.attach_pct_rank(ranked_customers(spark, folder), ["c_nationkey"], RANK_COLS)
    return out.select("c_custkey", *RANK_COLS)


@register(
    QUERIES,
    SQL,
    "SELECT c_custkey, "
    + ", ".join(f"round({rank_sql(c, 'c_nationkey')}, 6) AS {n}" for n, c in RANK_COLS.items())
    + f" FROM ({RANK_BASE})",
)
def pct_rank_raw(spark, folder):
    out = ranks.attach_pct_rank(
        ranked_customers(spark, folder), ["c_nationkey"], RANK_COLS, rounded=False
    )
    return out.select("c_custkey", *[six(c).alias(c) for c in RANK_COLS])


@register(
    QUERIES,
    SQL,
    "SELECT c_custkey, "
    + ", ".join(
        f"CASE WHEN n >= 60 THEN round_even({rank_sql(c, 'c_nationkey')}, 0) END AS {n}"
        for n, c in RANK_COLS.items()
    )
    + f" FROM (SELECT *, count(*) OVER (PARTITION BY c_nationkey) AS n FROM ({RANK_BASE}))",
)
def gated_pct_rank(spark, folder):
    sized = groups.attach(
        ranked_customers(spark, folder), ["c_nationkey"], {"n": F.count("c_custkey")}
    )
    out = ranks.attach_pct_rank(sized, ["c_nationkey"], RANK_COLS, min_size=("n", 60))
    return out.select("c_custkey", *RANK_COLS)


@register(
    QUERIES,
    SQL,
    "SELECT c_custkey, "
    + ", ".join(
        f"CASE WHEN n >= 60 THEN round_even({rank_sql(c, 'c_nationkey')}, 0) END AS {n}"
        for n, c in RANK_COLS.items()
    )
    + f" FROM (SELECT *, count(*) OVER (PARTITION BY c_nationkey) AS n FROM ({RANK_BASE}))",
)
def pct_rank_many(spark, folder):
    """Several measures ranked together by row key."""
    sized = groups.attach(
        ranked_customers(spark, folder), ["c_nationkey"], {"n": F.count("c_custkey")}
    )
    ranked = ranks.rank_rows(
        sized, "c_custkey", ["c_nationkey"], RANK_COLS, min_size=("n", 60)
    )
    return sized.select("c_custkey").join(ranked, "c_custkey", "left")


@register(
    QUERIES,
    SQL,
    """SELECT c_custkey, round(sum(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END)
              OVER (PARTITION BY c_nationkey) / count(*) OVER (PARTITION BY c_nationkey), 6) AS rate
       FROM customer""",
)
def group_rate(spark, folder):
    flagged = customers(spark, folder).withColumn(
        "rich", F.when(F.col("c_acctbal") > 5000, 1).otherwise(0)
    )
    out = groups.attach_rate(flagged, ["c_nationkey"], {"rate": "rich"})
    return out.select("c_custkey", six("rate").alias("rate"))


@register(
    QUERIES,
    SQL,
    """WITH l AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d,
                         CAST(lag(o_orderdate, 1) OVER w AS DATE) AS d1,
                         CAST(lag(o_orderdate, 2) OVER w AS DATE) AS d2
                  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
       SELECT o_orderkey, CAST(d - d1 AS DOUBLE) AS gap1, CAST(d - d2 AS DOUBLE) AS gap2,
              round((d - d1) / 365.0, 6) AS years FROM l""",
)
def lag_gap(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", day("o_orderdate").alias("d"))
    out = ranks.attach_lag(
        orders, "o_custkey", ["d", "o_orderkey"], {"d1": ("d", 1), "d2": ("d", 2)}
    )
    return out.select(
        "o_orderkey",
        gap_days("d", "d1").cast("double").alias("gap1"),
        gap_days("d", "d2").cast("double").alias("gap2"),
        six(gap_years("d", "d1")).alias("years"),
    )
