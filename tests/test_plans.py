"""The physical plans that matter at scale."""

from pathlib import Path

import pytest

import querybook
from gradewell.operators import groups, joins, picks, ranks, spread
from gradewell.plans import deficiencies, scorecard, service_area
from gradewell.session import shared_folder
from limits import limits
from pyspark.sql import functions as F
from querybook.inputs import ASOF, derived_tables
from scans import counted_scans, plan

QUERIES = querybook.queries()


@pytest.fixture(scope="module")
def orders(spark, folder):
    return spark.read.parquet(f"{folder}/orders.parquet")


@pytest.fixture(scope="module")
def shared(spark):
    return shared_folder(spark).removeprefix("file:")


def test_row_choice_limits_groups_before_the_shuffle(orders):
    for df in (
        picks.last_per_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]),
        picks.dedup(orders, ["o_custkey", "o_orderstatus"], ["o_orderkey"]),
        picks.top_n_per_group(orders, ["o_custkey"], [F.col("o_orderkey").desc()], 3),
    ):
        text = plan(df)
        assert text.count("WindowGroupLimit (") >= 2 and "Partial" in text


def pinned_once(folder):
    """Parquet folders written under the shared folder."""
    return set(Path(folder).glob("pinned-*"))


def test_an_index_of_many_measures_counts_the_long_rows_in_one_exchange(spark, orders, shared):
    before = pinned_once(shared)
    measures = {f"m{i}": c for i, c in enumerate(["o_totalprice", "o_orderkey", "o_custkey"])}
    medians = ranks.group_medians(orders, ["o_orderstatus"], measures)
    assert len(pinned_once(shared) - before) == 1
    tree = plan(medians).split("\n\n")[0]
    # The rows themselves are in the written index: nothing reads the input again.
    assert "orders.parquet" not in plan(medians) and tree.count("Scan parquet") <= 2


def test_attach_has_no_window_and_reads_the_input_once_more(spark, orders, shared):
    before = pinned_once(shared)
    text = plan(groups.attach(orders, ["o_custkey"], {"n": F.count("o_orderkey")}))
    assert "Window" not in text and text.split("\n\n")[0].count("Scan parquet") == 2
    assert len(pinned_once(shared) - before) == 1


def test_a_chain_deals_its_base_out_once_per_key_set(spark, orders):
    stats = [groups.group_stats(orders, ["o_orderstatus"], {f"n{i}": F.count("o_orderkey")}) for i in range(6)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with limits(spark, rows=10):
            text = plan(joins.star_join(orders, [(s, ["o_orderstatus"]) for s in stats]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    salted = [line for line in text.splitlines() if "hashpartitioning(o_orderstatus" in line and "__salt0" in line]
    # The base and the six sides, each once.
    assert len(salted) == 7


def rows_by_task(df, *columns):
    """Rows of each shuffle task that has any."""
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("arrives", ["scanned", "dealt by the key", "equal rows dealt by the key"])
def test_no_task_gets_more_than_twice_the_limit_after_six_joins(spark, tmp_path, adaptive, arrives):
    rows, limit = 400_000, 20_000
    content = F.lit(1) if arrives.startswith("equal") else F.col("id")
    base = spark.range(0, rows + 40_000, numPartitions=16).select(
        F.when(F.col("id") < rows, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"), content.alias("v")
    )
    if arrives == "equal rows dealt by the key":
        base = spread.numbered(base.repartition(64, "k"))
    elif arrives == "dealt by the key":
        base = base.repartition(64, "k")
    sides = [(base.groupBy("k").agg(F.count(F.lit(1)).alias(f"n{i}")), ["k"]) for i in range(6)]
    settings = {
        "spark.sql.adaptive.enabled": adaptive,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        with limits(spark, rows=limit):
            joined = joins.star_join(base, sides)
        counts = rows_by_task(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(counts) == rows + 40_000 and max(counts) <= 2 * limit


def test_filters_and_columns_reach_the_scan(spark, folder):
    text = plan(QUERIES["filter_eq"](spark, folder))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderpriority:string>" in text
    text = plan(QUERIES["drop_null_keys"](spark, folder))
    assert "c_acctbal" not in text


@pytest.fixture(scope="module")
def sources(spark, folder, tmp_path_factory):
    """The jobs' input tables, each in a file of its own."""
    place = tmp_path_factory.mktemp("sources")
    out = {}
    for name, df in derived_tables(spark, folder).items():
        df.write.parquet(str(place / f"{name}.parquet"))
        out[name] = spark.read.parquet(str(place / f"{name}.parquet"))
    return out


def test_the_scorecard_reads_each_source_at_most_twice(spark, sources):
    with counted_scans() as (scans, actions):
        full = scorecard.full_table(sources, ASOF)
        full.collect()
    read = {name: scans[f"{name}.parquet"] for name in sources}
    assert max(read.values()) <= 2 and min(read.values()) >= 1, read
    assert sum(actions.values()) < 50, actions


def test_the_deficiency_and_area_jobs_read_each_source_at_most_twice(spark, sources):
    jobs = {
        "findings": lambda: deficiencies.deficiency_rows(
            sources["health_deficiencies"], sources["complaint_surveys"], sources["patient_survey"], sources["zip_county"], ASOF
        ),
        "area": lambda: service_area.service_area(sources["provider_zips"], sources["zip_county"]),
        "benchmark": lambda: service_area.state_benchmark(sources["facility_rates"], sources["facilities_monthly"]),
    }
    for name, job in jobs.items():
        with counted_scans() as (scans, _):
            job().collect()
        read = {table: scans[f"{table}.parquet"] for table in sources if scans[f"{table}.parquet"]}
        assert read and max(read.values()) <= 2, (name, read)


CHEAP = sorted(set(QUERIES) - {"scorecard_table", "network_table"})


def test_no_query_runs_python_per_row_or_pairs_everything(spark, folder):
    for name in CHEAP:
        tree = plan(QUERIES[name](spark, folder)).split("\n\n")[0]
        assert "Python" not in tree and "Pandas" not in tree and "Arrow" not in tree, name
        assert "CartesianProduct" not in tree and "NestedLoop" not in tree, name
