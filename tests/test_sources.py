"""Sources and sinks on small files."""

import os
import time

import pytest
from pyspark.sql import functions as F

from gradewell.plans import profile
from gradewell.sources import pages, sinks, tables


def files(path, ending=".csv"):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(ending)]


def test_write_by_keeps_order_and_splits_a_large_key(spark, tmp_path):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "CA").when(F.col("id") % 3 == 1, "FL").otherwise("TX").alias("state"),
        (F.col("id") * 7919 % 3001).alias("n"),
        F.concat(F.lit("row, "), "id").alias("t"),
    )
    place = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_by(df, "state", ["CA", "FL"], place, ["n"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(d for d in os.listdir(place) if "=" in d) == ["by_state=CA", "by_state=FL"]
    for state in ("CA", "FL"):
        parts = sorted(files(f"{place}/by_state={state}"))
        assert len(parts) > 1
        rows = [line for part in parts for line in open(part).read().splitlines()[1:]]
        numbers = [int(r.split(",")[1]) for r in rows]
        assert numbers == sorted(numbers) and len(numbers) == 1000
    back = tables.read_csv(spark, place)
    assert back.count() == 2000 and set(back.columns) >= {"state", "n", "t"}


def test_write_single_writes_the_files_asked_for(spark, tmp_path):
    df = spark.range(100, numPartitions=4).select(F.col("id").cast("string"))
    sinks.write_single(df, str(tmp_path / "one"))
    sinks.write_single(df, str(tmp_path / "many"), files=4)
    assert len(files(tmp_path / "one")) == 1 and len(files(tmp_path / "many")) == 4
    assert tables.read_csv(spark, str(tmp_path / "many")).count() == 100


def test_latest_snapshot_reads_only_the_newest_files(spark, tmp_path):
    import os

    for n in range(4):
        spark.range(n, n + 1).coalesce(1).write.parquet(str(tmp_path / f"s{n}"))
        for f in (tmp_path / f"s{n}").iterdir():
            os.utime(f, (1_700_000_000 + n * 1000,) * 2)
    df = spark.read.parquet(*[str(tmp_path / f"s{n}") for n in range(4)])
    newest = tables.latest_snapshot(df)
    assert [r["id"] for r in newest.collect()] == [3]
    scan = newest._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def test_latest_snapshot_by_file_time(spark, tmp_path):
    for n in (1, 2):
        part = tmp_path / f"s{n}.csv"
        part.write_text(f"v\n{n}\n")
        os.utime(part, (time.time() - 1000 + n * 100,) * 2)
    df = spark.read.option("header", True).csv(str(tmp_path))
    assert [r["v"] for r in tables.latest_snapshot(df).collect()] == ["2"]
    named = tables.select_files(df, r"^s1\.").select("v", "file_name")
    assert [tuple(r) for r in named.collect()] == [("1", "s1.csv")]


def test_schema_is_enforced(spark, tmp_path):
    (tmp_path / "t_2020.csv").write_text("a,b\n1,x\n")
    (tmp_path / "bad.csv").write_text("a,b\noops,x\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    read = tables.read_tables(spark, str(tmp_path), {"t_2020": schema, "bad": schema})
    routed = tables.route(read, "2020")
    assert list(routed) == ["t"] and routed["t"].collect()[0]["a"] == 1
    with pytest.raises(Exception):
        read["bad"].collect()


def test_profile_run_over_chosen_files(spark, tmp_path):
    header = "EncType,ADMITTING_SOURCE,Discharge_Disposition,Discharge_Status,ADate,DDate\n"
    (tmp_path / "enc.csv").write_text(
        header + "IP,S,D,H,7/4/2020,2020-07-09\nIP,S,D,H,07/04/2020,2020-07-09\n"
        "IP,S,D,,bad,2020-07-09\nAV,,D,H,,2020-07-10\n"
    )
    (tmp_path / "people.csv").write_text("PatID,RACE\n1,2\n")
    (tmp_path / "more.csv").write_text("x,race\n1,2\n")
    (tmp_path / "odd.csv").write_text("x,y\n1,2\n")
    paths = [str(tmp_path / f"{n}.csv") for n in ("enc", "people", "odd")]
    out = profile.run_profile(spark, paths)
    counts = {(r["EncType"], r["YearMonth"]): r["count"] for r in out["profile"].collect()}
    assert counts == {("IP", "2020-7"): 2, ("IP", None): 1, ("AV", None): 1}
    assert {tuple(r) for r in out["rollup"].collect()} == {("IP", "2020-07-09", 3), ("AV", "2020-07-10", 1)}
    assert set(tables.load_classified(spark, paths)) == {"ENCOUNTER", "DEMOGRAPHIC"}
    with pytest.raises(ValueError, match="two files"):
        tables.load_classified(spark, [*paths, str(tmp_path / "more.csv")])
    with pytest.raises(ValueError, match="neither"):
        tables.scan(spark, "a.xlsx")
    assert profile.run_profile(spark, paths[1:]) == {}


def test_pages(spark):
    html = [
        '<h1 id="title">A &amp; <b>B</b></h1><a class="x y" href="/one.json">1</a>'
        "<a href='/two' class=\"y\">2</a><!-- <a href='/no'> --><a name=z>3</a><A HREF=/bare>4</A>",
        "<h1>no links</h1>",
        '<p>no title</p><a title="a > b" href="/three.json?json=1">x</a>',
        None,
    ]
    df = spark.createDataFrame(list(enumerate(html)), "page_id int, html string")
    catalog = [tuple(r) for r in pages.link_catalog(df).orderBy("page_id").collect()]
    assert catalog == [
        (0, "A & B", "/one.csv"),
        (1, "no links", None),
        (2, None, "/three.csv?csv=1"),
        (3, None, None),
    ]
    links = [tuple(r) for r in pages.extract_links(df).orderBy("page_id", "position").collect()]
    assert [x[2] for x in links] == ["/one.json", "/two", "/bare", "/three.json?json=1"]
    by_class = pages.link_catalog(df, link_class="y", title_id="title").orderBy("page_id").collect()
    assert tuple(by_class[0])[1:] == ("A & B", "/one.csv") and by_class[1]["Name"] is None
    exact = pages.extract_links(df, link_class="x y").collect()
    assert [r["href"] for r in exact] == ["/one.json"]
