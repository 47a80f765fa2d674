"""Scalar functions."""

from __future__ import annotations

from gradewell.functions import dates, flags, numbers, text
from pyspark.sql import functions as F
from querybook.tools import iso, load, register, six

QUERIES: dict = {}
SQL: dict[str, str] = {}


@register(
    QUERIES,
    SQL,
    """SELECT c_custkey,
              repeat('0', greatest(3 - length(CAST(c_custkey AS VARCHAR)), 0)) || c_custkey AS three,
              repeat('0', greatest(6 - length(CAST(c_custkey AS VARCHAR)), 0)) || c_custkey AS six
       FROM customer""",
)
def pad_code(spark, folder):
    return load(spark, folder, "customer").select(
        "c_custkey",
        text.pad_code("c_custkey", 3).alias("three"),
        text.pad_code("c_custkey", 6).alias("six"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT doc_id, replace(text, ',', ';') AS semicolons, replace(text, ',', ' ') AS blanks,
              replace(text, '-', '') AS joined FROM documents""",
)
def text_replace(spark, folder):
    return load(spark, folder, "documents").select(
        "doc_id",
        text.swap("text", ",", ";").alias("semicolons"),
        text.swap("text", ",", " ").alias("blanks"),
        text.swap("text", "-", "").alias("joined"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, trim(' ' || p_name || ' ') AS bare,
              (SELECT string_agg(upper(substr(w, 1, 1)) || lower(substr(w, 2)), '-' ORDER BY i)
               FROM (SELECT unnest(string_split(replace(p_name, ' ', '-'), '-')) AS w,
                            unnest(range(1, 10)) AS i) WHERE w IS NOT NULL) AS titled,
              length(p_name) AS n
       FROM part""",
)
def case_rules(spark, folder):
    return load(spark, folder, "part").select(
        "p_partkey",
        F.upper("p_name").alias("up"),
        F.lower("p_brand").alias("low"),
        F.trim(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("bare"),
        text.title(text.swap("p_name", " ", "-")).alias("titled"),
        F.length("p_name").cast("long").alias("n"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN l_partkey % 100000 BETWEEN 1 AND 9999
                   THEN l_returnflag || '-' || right('0000' || (l_partkey % 100000), 4) END AS tag
       FROM lineitem""",
)
def tag_code(spark, folder):
    number = (F.col("l_partkey") % 100000).cast("double")
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text.tag_code("l_returnflag", number).alias("tag")
    )


@register(
    QUERIES,
    SQL,
    """SELECT c_custkey, c_mktsegment || '_' || c_nationkey AS group_id, '''' || c_custkey AS quoted
       FROM customer""",
)
def compound_key(spark, folder):
    return load(spark, folder, "customer").select(
        "c_custkey",
        text.compound_key("c_mktsegment", "c_nationkey").alias("group_id"),
        F.concat(F.lit("'"), F.col("c_custkey")).alias("quoted"),
    )


@register(
    QUERIES,
    SQL,
    r"""SELECT page_id, regexp_extract(url, '([^/.]*)[^/]*$', 1) AS stem,
               'x' || page_id AS made FROM pages""",
)
def file_stem(spark, folder):
    made = F.concat(F.lit("C:\\data\\x"), F.col("page_id"), F.lit(".raw.csv"))
    return load(spark, folder, "pages").select(
        "page_id", text.file_stem("url").alias("stem"), text.file_stem(made).alias("made")
    )


@register(
    QUERIES,
    SQL,
    """SELECT n_nationkey, c_custkey,
              'NORTH|' || upper(n_name) || '|STREET|1ST|' || regexp_replace(upper(c_name), '[^A-Z0-9]', '', 'g')
                || '|BLVD' AS words
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def street_normalize(spark, folder):
    customer = load(spark, folder, "customer")
    nation = load(spark, folder, "nation")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    street = F.concat(
        F.lit("n. "), "n_name", F.lit(" st, First "), "c_name", F.lit(" Boulevard")
    )
    return rows.select(
        "n_nationkey", "c_custkey", F.array_join(text.street_words(street), "|").alias("words")
    )


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS compact,
              strftime(o_orderdate, '%Y-%m-%d') AS us,
              year(o_orderdate) || '-' || month(o_orderdate) AS ym,
              CAST(NULL AS VARCHAR) AS bad
       FROM orders""",
)
def parse_dates(spark, folder):
    d = F.col("o_orderdate")
    return load(spark, folder, "orders").select(
        "o_orderkey",
        iso(dates.compact_date(F.date_format(d, "yyyy-MM-dd"))).alias("compact"),
        iso(dates.us_date(F.date_format(d, "M/d/yyyy"))).alias("us"),
        dates.year_month(F.date_format(d, "MM/dd/yyyy")).alias("ym"),
        iso(dates.us_date(F.date_format(d, "yyyy.MM.dd"))).alias("bad"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT l_orderkey, l_linenumber, round((l_discount + l_tax) / 2, 6) AS two,
              CASE WHEN l_quantity > 10
                   THEN round((l_discount + l_tax + l_quantity + l_linenumber) / 4, 6) END AS four
       FROM lineitem""",
)
def row_mean(spark, folder):
    lines = load(spark, folder, "lineitem").withColumn(
        "q", F.when(F.col("l_quantity") > 10, F.col("l_quantity"))
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        six(numbers.row_mean("l_discount", "l_tax")).alias("two"),
        six(numbers.row_mean("l_discount", "l_tax", "q", "l_linenumber")).alias("four"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) END AS r,
              CASE WHEN l_tax + l_discount <> 0
                   THEN round(l_tax / (l_tax + l_discount) * 100, 6) END AS share
       FROM lineitem""",
)
def guarded_ratio(spark, folder):
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        six(numbers.ratio("l_tax", "l_discount")).alias("r"),
        six(numbers.ratio("l_tax", F.col("l_tax") + F.col("l_discount"), 100)).alias("share"),
    )


@register(
    QUERIES,
    SQL,
    r"""SELECT event_id,
               CASE WHEN event_id % 4 <> 0
                    THEN TRY_CAST(regexp_extract(props, ': *(\d+)', 1) AS DOUBLE) END AS k,
               coalesce(CAST(CAST(floor(CASE WHEN value > 5 THEN value END) AS BIGINT) AS VARCHAR), '0')
                 AS whole
        FROM events""",
)
def coerce_numeric(spark, folder):
    found = F.regexp_extract("props", r": *(\d+)", 1)
    raw = F.when(F.col("event_id") % 4 == 0, "Not Available").otherwise(found)
    return load(spark, folder, "events").select(
        "event_id",
        numbers.to_number(raw).alias("k"),
        numbers.to_int_text(F.when(F.col("value") > 5, F.col("value"))).alias("whole"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y%m%d') AS day FROM orders""",
)
def to_text(spark, folder):
    return load(spark, folder, "orders").select(
        text.to_text("o_orderkey").alias("id"), text.to_text("o_orderdate", "yyyyMMdd").alias("day")
    )


LINE_RULES = [
    flags.Rule("low_qty", "l_quantity", "<", 10),
    flags.Rule("high_price", "l_extendedprice", ">", 50000.0),
    flags.Rule("top_tax", "l_tax", ">=", 0.08),
    flags.Rule("mid_discount", "l_discount", "between", (0.02, 0.05)),
    flags.Rule("edge_line", "l_linenumber", "in", (1, 7)),
    flags.Rule("returned", "l_returnflag", "==", "R"),
    flags.Rule("known_high", "maybe", ">", 40),
]


@register(
    QUERIES,
    SQL,
    """SELECT l_orderkey, l_linenumber, (l_quantity < 10)::INT AS low_qty,
              (l_extendedprice > 50000)::INT AS high_price, (l_tax >= 0.08::DOUBLE)::INT AS top_tax,
              (l_discount >= 0.02::DOUBLE AND l_discount <= 0.05::DOUBLE)::INT AS mid_discount,
              (l_linenumber = 1 OR l_linenumber = 7)::INT AS edge_line,
              (l_returnflag = 'R')::INT AS returned,
              (l_quantity > 40 AND l_quantity <> 50)::INT AS known_high
       FROM lineitem""",
)
def threshold_flags(spark, folder):
    lines = load(spark, folder, "lineitem").withColumn("maybe", F.nullif("l_quantity", F.lit(50.0)))
    return lines.withColumns(flags.rule_flags(LINE_RULES)).select(
        "l_orderkey", "l_linenumber", *[r.flag for r in LINE_RULES]
    )


@register(
    QUERIES,
    SQL,
    """SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 0 ELSE 1 END AS has_nation,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS has_segment FROM customer""",
)
def presence_flags(spark, folder):
    return load(spark, folder, "customer").select(
        "c_custkey",
        flags.present(F.nullif("c_nationkey", F.lit(0))).alias("has_nation"),
        flags.present(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("has_segment"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Standard' ELSE 'Complaint' END AS cycle
       FROM orders""",
)
def decode_binary_label(spark, folder):
    return load(spark, folder, "orders").select(
        "o_orderkey", flags.decode("o_orderstatus", {"O": "Standard"}, "Complaint").alias("cycle")
    )


@register(
    QUERIES,
    SQL,
    """SELECT p_partkey, CASE WHEN p_type LIKE '%LARGE%' THEN 'L' WHEN p_type LIKE '%PROMO%' THEN 'P'
              WHEN p_type LIKE '%ECONOMY%' THEN 'E' ELSE 'N/A' END AS kind,
              CASE WHEN p_name LIKE '%o%' THEN 'o' WHEN p_name LIKE '%e%' THEN 'e' ELSE 'N/A' END AS vowel,
              CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%bolt%' THEN 1 ELSE 0 END AS hardware
       FROM part""",
)
def decode_contains(spark, folder):
    kinds = [("ECONOMY", "E"), ("PROMO", "P"), ("LARGE", "L")]
    return load(spark, folder, "part").select(
        "p_partkey",
        flags.decode_contains("p_type", kinds, "N/A").alias("kind"),
        flags.decode_contains("p_name", [("e", "e"), ("o", "o")], "N/A").alias("vowel"),
        flags.flag(text.contains_any("p_name", ["ring", "bolt"])).alias("hardware"),
    )


@register(
    QUERIES,
    SQL,
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 'No' ELSE 'Yes' END AS answer
       FROM lineitem""",
)
def service_yes_no(spark, folder):
    answer = flags.yes_no(F.nullif("l_returnflag", F.lit("A")), "N")
    return load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", answer.alias("answer"))


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN 'D' WHEN '3' THEN 'C'
              WHEN '5' THEN 'A' ELSE 'N/A' END AS letter FROM orders""",
)
def decode_letter(spark, folder):
    mapping = {"1-URGENT": "D", "3-MEDIUM": "C", "5-LOW": "A"}
    return load(spark, folder, "orders").select(
        "o_orderkey", flags.decode("o_orderpriority", mapping, "N/A").alias("letter")
    )
