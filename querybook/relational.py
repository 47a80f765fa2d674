"""Filters, joins, row choice and sorting."""

from __future__ import annotations


from gradewell.functions.flags import decode, flag
from gradewell.operators import filters, groups, joins, picks
from pyspark.sql import functions as F
from querybook.tools import day, iso, load, newest, register

QUERIES: dict = {}
SQL: dict[str, str] = {}


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'""",
)
def filter_eq(spark, folder):
    orders = load(spark, folder, "orders")
    kept = orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT"))
    return kept.select("o_orderkey", "o_custkey")


@register(
    QUERIES,
    SQL,
    """WITH a AS (SELECT CAST(max(o_orderdate) AS DATE) AS until FROM orders)
       SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Standard' ELSE 'Complaint' END AS label,
              strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(until, '%Y/%m') AS month
       FROM orders, a
       WHERE CAST(o_orderdate AS DATE) <= until
         AND ((o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) > until - INTERVAL 36 MONTH)
           OR (o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) > until - INTERVAL 18 MONTH))""",
)
def lookback_window(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", day("o_orderdate").alias("d")
    )
    asof = newest(orders, "d")
    kept = filters.in_cycle_windows(orders, "o_orderstatus", "d", asof, {"O": 36, "F": 18})
    return kept.select(
        "o_orderkey",
        decode("o_orderstatus", {"O": "Standard"}, "Complaint").alias("label"),
        iso("d").alias("day"),
        F.date_format(asof, "yyyy/MM").alias("month"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2, 3) THEN 1 ELSE 0 END AS low,
              CASE WHEN l_returnflag IN ('A', 'R') THEN 1 ELSE 0 END AS sent_back FROM lineitem""",
)
def isin_flags(spark, folder):
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        flag(F.col("l_linenumber").isin(1, 2, 3)).alias("low"),
        flag(F.col("l_returnflag").isin("A", "R")).alias("sent_back"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT p_partkey, replace(p_name, ' ', ';') AS p_name FROM part
       WHERE NOT (p_name LIKE '%red%' OR p_name LIKE '%bolt%' OR p_name LIKE '%Large%'
                  OR p_name LIKE '%small%')""",
)
def exclude_words(spark, folder):
    part = load(spark, folder, "part").select("p_partkey", "p_name")
    kept = filters.exclude_matching(part, "p_name", ["red", "bolt", "Large", "small"])
    return kept.withColumn("p_name", F.replace("p_name", F.lit(" "), F.lit(";")))


@register(
    QUERIES,
    SQL,
    """SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey <> 3 AND c_mktsegment <> 'BUILDING'""",
)
def drop_null_keys(spark, folder):
    customer = load(spark, folder, "customer").select(
        "c_custkey",
        F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"),
    )
    return filters.require(customer, ["c_nationkey", "seg"]).drop("seg")


@register(QUERIES, SQL, "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_keys(spark, folder):
    return filters.distinct_keys(load(spark, folder, "orders"), "o_orderstatus", "o_orderpriority")


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, o_custkey, CAST(c_custkey AS DOUBLE) AS c_custkey, c_mktsegment
       FROM orders LEFT JOIN (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END AS c_custkey,
                                     c_mktsegment FROM customer) ON o_custkey = c_custkey""",
)
def left_join_renamed(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    key = F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(-F.col("c_custkey"))
    customer = load(spark, folder, "customer").select(key.cast("double").alias("c_custkey"), "c_mktsegment")
    return joins.left_join(orders, customer, "o_custkey", "c_custkey")


@register(
    QUERIES,
    SQL,
    """SELECT c_custkey, c_nationkey, n_nationkey, n_name FROM customer
       JOIN nation ON c_nationkey = n_nationkey""",
)
def dim_join(spark, folder):
    customer = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, folder, "nation").select("n_nationkey", "n_name")
    return joins.dim_join(customer, nation, "c_nationkey", "n_nationkey")


@register(
    QUERIES,
    SQL,
    """SELECT DISTINCT ON (c_nationkey, c_custkey) c_nationkey, c_custkey, s_suppkey, s_name
       FROM customer JOIN supplier ON c_nationkey = s_nationkey
       ORDER BY c_nationkey, c_custkey, s_suppkey""",
)
def fanout_dedup(spark, folder):
    customer = load(spark, folder, "customer").select("c_nationkey", "c_custkey")
    supplier = load(spark, folder, "supplier").select("s_nationkey", "s_suppkey", "s_name")
    return picks.fanout_join(
        customer, supplier, "c_nationkey", "s_nationkey", ["s_suppkey"]
    ).drop("s_nationkey")


@register(
    QUERIES,
    SQL,
    """WITH f AS (SELECT o_custkey, o_orderdate, count(*) AS n FROM orders
                  WHERE o_orderstatus <> 'O' GROUP BY 1, 2),
            l AS (SELECT o_custkey, n FROM f
                  WHERE (o_custkey, o_orderdate) IN
                        (SELECT (o_custkey, max(o_orderdate)) FROM f GROUP BY o_custkey))
       SELECT o.o_orderkey, o.o_custkey, CAST(l.n AS DOUBLE) AS other_count
       FROM orders o LEFT JOIN l ON o.o_custkey = l.o_custkey WHERE o_orderstatus = 'O'""",
)
def attach_other_cycle_count(spark, folder):
    orders = load(spark, folder, "orders")
    base = orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey")
    other = orders.where("o_orderstatus <> 'O'").select("o_custkey", "o_orderdate")
    out = picks.attach_other(base, other, "o_custkey", "o_orderdate", "other_count")
    return out.select(
        "o_orderkey", "o_custkey", F.col("other_count").cast("double").alias("other_count")
    )


@register(
    QUERIES,
    SQL,
    """SELECT o.o_orderkey, o.o_custkey, strftime(o.o_orderdate, '%Y-%m-%d') AS day,
              a.n AS n, b.top AS top, c.urgent AS urgent
       FROM orders o
       JOIN (SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2) a
         ON o.o_custkey = a.o_custkey AND o.o_orderdate = a.o_orderdate
       JOIN (SELECT o_custkey, o_orderdate, max(o_totalprice) AS top FROM orders GROUP BY 1, 2) b
         ON o.o_custkey = b.o_custkey AND o.o_orderdate = b.o_orderdate
       JOIN (SELECT o_custkey, o_orderdate,
                    count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent
             FROM orders GROUP BY 1, 2) c
         ON o.o_custkey = c.o_custkey AND o.o_orderdate = c.o_orderdate""",
)
def reduce_join(spark, folder):
    orders = load(spark, folder, "orders")
    keys = ["o_custkey", "o_orderdate"]
    sides = [
        groups.group_count(orders, keys, "o_orderkey", "n"),
        groups.group_stats(orders, keys, {"top": F.max("o_totalprice")}),
        groups.group_stats(
            orders, keys, {"urgent": F.count_if(F.col("o_orderpriority") == "1-URGENT")}
        ),
    ]
    out = joins.reduce_join([orders.select("o_orderkey", *keys), *sides], keys)
    return out.select("o_orderkey", "o_custkey", iso("o_orderdate").alias("day"), "n", "top", "urgent")


@register(
    QUERIES,
    SQL,
    """SELECT n_name, r_name, p_type, count(*) AS lines, count(s_name) AS local_lines,
              round(sum(l_quantity), 2) AS quantity
       FROM lineitem
       LEFT JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey
       LEFT JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
       LEFT JOIN part ON l_partkey = p_partkey
       GROUP BY 1, 2, 3""",
)
def star_left_join(spark, folder):
    def side(name, renames):
        return load(spark, folder, name).select(*[F.col(a).alias(b) for a, b in renames.items()])

    lines = side(
        "lineitem",
        {"l_orderkey": "order", "l_partkey": "part", "l_suppkey": "supplier", "l_quantity": "qty"},
    )
    sides = [
        (side("orders", {"o_orderkey": "order", "o_custkey": "customer"}), ["order"]),
        (side("customer", {"c_custkey": "customer", "c_nationkey": "nation"}), ["customer"]),
        (
            side("nation", {"n_nationkey": "nation", "n_name": "n_name", "n_regionkey": "region"}),
            ["nation"],
        ),
        (side("region", {"r_regionkey": "region", "r_name": "r_name"}), ["region"]),
        (
            side(
                "supplier", {"s_suppkey": "supplier", "s_nationkey": "nation", "s_name": "s_name"}
            ),
            ["supplier", "nation"],
        ),
        (side("part", {"p_partkey": "part", "p_type": "p_type"}), ["part"]),
    ]
    return joins.star_join(lines, sides).groupBy("n_name", "r_name", "p_type").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("s_name").alias("local_lines"),
        F.round(F.sum("qty"), 2).alias("quantity"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT c.c_nationkey AS nation, c.c_custkey AS id, c.c_name AS name_x, n.n_name AS name_y,
              c.c_acctbal AS acctbal_x, s.best AS acctbal_y
       FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN (SELECT s_nationkey, max(s_acctbal) AS best FROM supplier GROUP BY 1) s
         ON s.s_nationkey = n.n_nationkey""",
)
def suffix_join(spark, folder):
    left = load(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"),
    )
    best = groups.group_stats(
        load(spark, folder, "supplier"), ["s_nationkey"], {"acctbal": F.max("s_acctbal")}
    )
    right = load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name")
    )
    right = joins.lookup_join(right, best.withColumnRenamed("s_nationkey", "nation"), ["nation"])
    return joins.join_suffixed(left, right, ["nation"])


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders o
       WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders i WHERE i.o_custkey = o.o_custkey)""",
)
def rows_of_latest_date(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = picks.rows_of_latest(orders, "o_custkey", "o_orderdate")
    return out.select("o_orderkey", "o_custkey", iso("o_orderdate").alias("day"))


@register(
    QUERIES,
    SQL,
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def last_per_group(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"
    )
    out = picks.last_per_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return out.drop("o_orderdate")


@register(
    QUERIES,
    SQL,
    """SELECT o_custkey, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey
       FROM orders GROUP BY 1""",
)
def first_per_group(spark, folder):
    orders = load(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    out = picks.first_per_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return out.drop("o_orderdate")


@register(
    QUERIES,
    SQL,
    """SELECT o_custkey, o_orderstatus, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
              CAST(1 AS BIGINT) AS kept
       FROM orders GROUP BY 1, 2""",
)
def dedup_first(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_orderdate"
    )
    out = picks.dedup(orders, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"])
    return out.drop("o_orderdate").withColumn("kept", F.lit(1).cast("long"))


@register(
    QUERIES,
    SQL,
    """SELECT c_mktsegment, c_name, c_custkey, c_acctbal FROM customer
       ORDER BY c_mktsegment, c_acctbal DESC, c_custkey""",
)
def sorted_publish(spark, folder):
    customer = load(spark, folder, "customer").drop("c_nationkey")
    return customer.orderBy("c_mktsegment", F.col("c_acctbal").desc(), "c_custkey")


