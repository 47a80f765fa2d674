"""Sources, sinks and column-set operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewell.operators import columns
from gradewell.session import scratch_path
from gradewell.sources import sinks
from gradewell.sources import tables as sources
from querybook.tools import load, register

QUERIES: dict = {}
SQL: dict[str, str] = {}


@register(QUERIES, SQL, "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def csv_roundtrip(spark, folder):
    wanted = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    table = columns.select_cols(load(spark, folder, "customer"), wanted)
    place = scratch_path(spark, "csv")
    table.write.option("header", True).csv(f"{place}/customer.csv")
    return sources.read_tables(spark, place, {"customer": table.schema})["customer"]


@register(
    QUERIES,
    SQL,
    "SELECT o_orderstatus, count(*) AS from_parquet, count(*) AS from_csv FROM orders GROUP BY 1",
)
def scan_by_ext(spark, folder):
    place = scratch_path(spark, "scan") + "/orders.csv"
    parquet = sources.scan(spark, f"{folder}/orders.parquet")
    parquet.select("o_orderkey", "o_orderstatus").write.option("header", True).csv(place)
    csv = sources.scan(spark, place, T.StructType.fromDDL("o_orderkey long, o_orderstatus string"))
    a = parquet.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("from_parquet"))
    b = csv.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("from_csv"))
    return a.join(b, "o_orderstatus")


@register(QUERIES, SQL, "SELECT p_partkey, p_brand, p_size FROM part")
def lookup_select(spark, folder):
    return sources.read_lookup(spark, f"{folder}/part.parquet", ["p_partkey", "p_brand", "p_size"])


@register(QUERIES, SQL, "SELECT p_partkey, p_name, p_brand FROM part")
def decode_binary(spark, folder):
    raw = load(spark, folder, "part").select(
        "p_partkey", F.encode("p_name", "UTF-8").alias("p_name"), F.encode("p_brand", "UTF-8").alias("p_brand")
    )
    return columns.decode_binary(raw)


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def latest_snapshot(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    return sources.latest_snapshot(orders, "o_orderdate").drop("o_orderdate")


@register(
    QUERIES,
    SQL,
    """SELECT 'customer.parquet' AS file_name, count(*) AS n FROM customer
       UNION ALL SELECT 'orders.parquet', count(*) FROM orders""",
)
def file_name_filter(spark, folder):
    chosen = []
    for key in ("c_custkey", "o_custkey"):
        reader = spark.read.schema(T.StructType.fromDDL(f"{key} long"))
        files = reader.option("pathGlobFilter", "*.parquet").parquet(folder)
        pattern = r"^customer\." if key == "c_custkey" else r"^orders\."
        chosen.append(sources.select_files(files, pattern).groupBy("file_name").agg(
            F.count(key).alias("n")
        ))
    return chosen[0].unionByName(chosen[1])


# Stand-in tables, each with one class's signature column in some letter case.
CLASS_TABLES = {
    "visits": ("events", "event_type", "Discharge_Disposition"),
    "people": ("customer", "c_mktsegment", "RACE"),
    "drugs": ("part", "p_type", "rx_codetype"),
    "doctors": ("supplier", "s_name", "specialty"),
    "bills": ("orders", "o_orderstatus", "o_orderstatus"),
}


@register(
    QUERIES,
    SQL,
    """SELECT 'visits' AS file, 'ENCOUNTER' AS class, count(*) AS n FROM events
       UNION ALL SELECT 'people', 'DEMOGRAPHIC', count(*) FROM customer
       UNION ALL SELECT 'drugs', 'DISPENSING', count(*) FROM part
       UNION ALL SELECT 'doctors', 'PROVIDER', count(*) FROM supplier
       UNION ALL SELECT 'bills', 'UNKNOWN_DATASET', count(*) FROM orders""",
)
def classify_tables(spark, folder):
    found = []
    for file, (table, column, sign) in CLASS_TABLES.items():
        df = load(spark, folder, table).withColumnRenamed(column, sign)
        found.append(df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(file).alias("file"), F.lit(sources.classify(df)).alias("class"), "n"
        ))
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


@register(
    QUERIES,
    SQL,
    """SELECT c_mktsegment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') GROUP BY 1""",
)
def partitioned_sink(spark, folder):
    place = scratch_path(spark, "by-segment")
    table = load(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    sinks.write_by(
        table, "c_mktsegment", ["BUILDING", "MACHINERY", "FURNITURE"], place, ["c_name", "c_custkey"]
    )
    back = sources.read_csv(spark, place, None)
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c_custkey").cast("long")).alias("keys")
    )


@register(
    QUERIES,
    SQL,
    "SELECT c_nationkey, count(*) AS n, min(c_name) AS first_name FROM customer GROUP BY 1",
)
def single_sink(spark, folder):
    place = scratch_path(spark, "single") + "/customer.csv"
    table = load(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    sinks.write_single(table, place)
    return sources.read_csv(spark, place, table.schema).groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("c_name").alias("first_name")
    )


@register(
    QUERIES,
    SQL,
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def publish_select(spark, folder):
    return columns.select_cols(
        load(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_quantity", "l_orderkey", "l_returnflag"],
    )


@register(QUERIES, SQL, "SELECT o_orderkey AS id, o_custkey AS owner, o_orderstatus FROM orders")
def rename_map(spark, folder):
    table = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return columns.rename(table, {"o_orderkey": "id", "o_custkey": "owner"})


@register(
    QUERIES,
    SQL,
    """SELECT p_partkey AS part_key_id, p_name AS name_full_text, p_size AS size FROM part""",
)
def normalize_headers(spark, folder):
    raw = load(spark, folder, "part").select(
        F.col("p_partkey").alias(" Part Key (ID)"),
        F.col("p_name").alias("Name, Full Text"),
        F.col("p_size").alias("SIZE "),
    )
    return columns.normalize_headers(raw)


@register(QUERIES, SQL, "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def drop_by_regex(spark, folder):
    raw = load(spark, folder, "supplier").withColumn("footnote_1", F.lit("x"))
    return columns.drop_matching(raw, "footnote|nationkey")


@register(QUERIES, SQL, "SELECT o_orderkey AS k, o_custkey AS v FROM orders")
def drop_dup_columns(spark, folder):
    orders = load(spark, folder, "orders")
    doubled = orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"), F.col("o_totalprice").alias("k")
    )
    return columns.drop_dup_columns(doubled)


@register(
    QUERIES,
    SQL,
    """SELECT l_orderkey, l_linenumber, round(l_quantity / 100, 6) AS l_quantity,
              round(l_tax / 100, 6) AS l_tax FROM lineitem""",
)
def scale_columns(spark, folder):
    table = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax"
    )
    scaled = columns.scale(table, ["l_quantity", "l_tax"], 100)
    return scaled.withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_tax")})


@register(
    QUERIES,
    SQL,
    """SELECT p_partkey, upper(trim(p_name)) AS p_name, upper(trim(p_brand)) AS p_brand,
              upper(trim(p_type)) AS p_type, p_size FROM part""",
)
def apply_to_columns(spark, folder):
    table = load(spark, folder, "part").drop("p_retailprice")
    texts = columns.cols_of_type(table, T.StringType)
    return columns.apply_to(table, texts, lambda c: F.upper(F.trim(c)))


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, NULL::DOUBLE AS o_totalprice FROM orders
       WHERE o_orderstatus = 'O'
       UNION ALL
       SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus <> 'O'""",
)
def union_by_name(spark, folder):
    orders = load(spark, folder, "orders")
    return columns.union_all(
        [
            orders.where("o_orderstatus = 'O'").select(
                "o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey")
            ),
            orders.where("o_orderstatus <> 'O'").select("o_totalprice", "o_orderkey"),
        ]
    )


@register(
    QUERIES,
    SQL,
    """SELECT c_custkey,
              coalesce(CAST(nullif(c_nationkey, 0) AS BIGINT), 0) AS n0,
              coalesce(CAST(CAST(nullif(c_nationkey, 3) AS BIGINT) AS VARCHAR), 'N/A') AS na,
              coalesce(nullif(c_mktsegment, 'BUILDING'), 'N/A') AS seg
       FROM customer""",
)
def fill_defaults(spark, folder):
    nation = F.col("c_nationkey").cast("long")
    table = load(spark, folder, "customer").select(
        "c_custkey",
        F.nullif(nation, F.lit(0).cast("long")).alias("n0"),
        F.nullif(nation, F.lit(3).cast("long")).alias("na"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("seg"),
    )
    return columns.fill_defaults(table, {"n0": 0, "na": "N/A", "seg": "N/A"})


@register(
    QUERIES,
    SQL,
    """SELECT p_partkey, unnest(CASE WHEN len(string_split(p_name, ' ')) > 1
                                     THEN list_concat([p_name], string_split(p_name, ' '))
                                     ELSE [p_name] END) AS p_name
       FROM part""",
)
def split_explode(spark, folder):
    table = load(spark, folder, "part").select("p_partkey", "p_name")
    return columns.split_explode(table, "p_name", " ", keep=True)


def write_snapshots(spark, folder):
    """Orders by year and customers by half, as two tables of several snapshots."""
    place = scratch_path(spark, "snapshots")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    years = [r["year"] for r in orders.select("year").distinct().collect()]
    for year in years:
        orders.where(F.col("year") == year).write.parquet(f"{place}/orders_{year}.parquet")
    customer = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    for half in (0, 1):
        part = customer.where(F.col("c_custkey") % 2 == half)
        part.write.option("header", True).csv(f"{place}/customer_h{half}.csv")
    spark.range(3).write.parquet(f"{place}/unrelated.parquet")
    return place


@register(
    QUERIES,
    SQL,
    """SELECT 'orders' AS name, CAST(year(o_orderdate) AS VARCHAR) AS snapshot, 'parquet' AS kind,
              count(*) AS n_rows, year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) AS newest
       FROM orders GROUP BY year(o_orderdate)
       UNION ALL
       SELECT 'customer', 'h' || CAST(c_custkey % 2 AS VARCHAR), 'csv', count(*), c_custkey % 2 = 1
       FROM customer GROUP BY c_custkey % 2""",
)
def snapshot_manifest(spark, folder):
    """Rows of every snapshot, the manifest joined to the rows by their files."""
    place = write_snapshots(spark, folder)
    manifest = sources.file_manifest(spark, place)
    newest = sources.chosen_places(manifest).select("name", F.col("snapshot").alias("last"))
    per_file = []
    for kind, reader in (("parquet", spark.read), ("csv", spark.read.option("header", True))):
        rows = reader.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{kind}")
        data = rows.format(kind).load(place).select(F.col("_metadata.file_path").alias("path"))
        per_file.append(data.groupBy("path").agg(F.count(F.lit(1)).alias("n")))
    counted = manifest.join(per_file[0].unionByName(per_file[1]), "path")
    sizes = counted.groupBy("name", "snapshot", "kind").agg(F.sum("n").alias("n_rows"))
    return sizes.join(newest, "name").select(
        "name", "snapshot", "kind", "n_rows", (F.col("snapshot") == F.col("last")).alias("newest")
    )


@register(
    QUERIES,
    SQL,
    """SELECT o_orderkey, o_custkey, c_nationkey FROM orders
       JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 1) ON o_custkey = c_custkey
       WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
)
def routed_snapshot(spark, folder):
    """Both tables at their newest snapshot; no other file is read."""
    schemas = {"customer": T.StructType.fromDDL("c_custkey long, c_nationkey int")}
    tables = sources.read_snapshot(spark, write_snapshots(spark, folder), schemas=schemas)
    orders, customer = tables["orders"], tables["customer"]
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "o_custkey", "c_nationkey")
