"""Ranks and statistics made once per provider equal those made on a row per county."""

import pytest
from pyspark.sql import functions as F

from gradewell.operators import ranks
from gradewell.operators.groups import group_stats, share
from gradewell.plans import scorecard
from gradewell.run import Run
from gradewell.session import METHOD_LIMIT
from querybook.jobs import six_places
from scans import plan
from test_score_rows import AREA, ROWS, Held


@pytest.fixture
def values(spark):
    """Rows that stand for 1 to 4 rows, with ties, holes in keys and values, and a text letter."""
    return spark.range(120).select(
        F.col("id"),
        F.when(F.col("id") % 13 != 0, F.col("id") % 3).alias("k"),
        *[F.when(F.col("id") % (7 + i) != 0, (F.col("id") * (i + 3) % 11) / 4).alias(f"m{i}") for i in range(3)],
        (F.col("id") % 2).cast("int").alias("flag"),
        F.element_at(F.array(F.lit("A"), F.lit("C"), F.lit("E")), (F.col("id") % 3 + 1).cast("int")).alias("letter"),
        (F.col("id") % 4 + 1).alias("served"),
    )


@pytest.fixture
def repeated(values):
    return values.withColumn("copy", F.explode(F.sequence(F.lit(1), "served"))).withColumn(
        "row", F.monotonically_increasing_id()
    )


def ways(spark, build):
    """The same ranks from lists and from a shuffled index."""
    yield build()
    spark.conf.set(ranks.LISTED_VALUES[0], "1")
    try:
        yield build()
    finally:
        spark.conf.unset(ranks.LISTED_VALUES[0])


def found(df, *columns):
    return sorted(df.select(*columns).distinct().collect(), key=str)


@pytest.mark.parametrize("rounded", [True, False])
def test_a_weight_ranks_as_that_many_rows_do(spark, values, repeated, rounded):
    rankings = [ranks.Ranking(["k"], {f"r{i}": f"m{i}" for i in range(3)})]
    names = ["id", "r0", "r1", "r2"]
    for weighed in ways(spark, lambda: ranks.rank_groups(values, "id", rankings, rounded, weight="served")):
        each = ranks.rank_groups(repeated, "row", rankings, rounded).join(repeated.select("row", "id"), "row")
        assert found(weighed, *names) == found(each, *names) != []
        assert weighed.count() == weighed.select("id").distinct().count()


def test_some_rows_rank_among_all_and_keep_their_columns(spark, values):
    rankings = [ranks.Ranking(["k"], {"r": "m0"}, ("served", 2)), ranks.Ranking(["flag"], {"f": "m1"})]
    whole = ranks.rank_groups(values, "id", rankings, keep=["k", "letter"])
    want = {r["id"]: r for r in whole.collect()}
    assert len(want) == 120 and any(r["r"] is None for r in want.values())
    some = values.where("id % 5 = 0")
    for ranked in ways(spark, lambda: ranks.rank_groups(some, "id", rankings, source=values, keep=["k", "letter"])):
        got = {r["id"]: r for r in ranked.collect()}
        assert got == {i: r for i, r in want.items() if i % 5 == 0}


def test_a_row_key_that_repeats_is_one_row(spark, values):
    twice = values.union(values.where("id % 4 = 0")).withColumn("id", F.when(F.col("id") != 5, F.col("id")))
    rankings = [ranks.Ranking(["k"], {"r": "m0", "s": "m1"})]
    listed, shuffled = ways(spark, lambda: ranks.rank_groups(twice, "id", rankings))
    assert listed.count() == listed.select("id").distinct().count()
    assert found(listed, "id", "r", "s") == found(shuffled, "id", "r", "s") != []


def test_rows_stay_where_they_are_for_a_short_index(spark, values):
    rankings = [ranks.Ranking(["k"], {f"r{i}": f"m{i}" for i in range(3)})]
    ranked = ranks.rank_groups(values, "id", rankings, keep=["letter"])
    tree = plan(ranked).split("\n\n")[0]
    assert "Generate" not in tree and "SortMergeJoin" not in tree and tree.count("BroadcastHashJoin") == 1


def test_weighed_shares_medians_and_letter_means(spark, values, repeated):
    pairs = {"mean": ("letter", "m0")}
    weighed, each = (scorecard.letter_means(values, pairs, "served"), scorecard.letter_means(repeated, pairs))
    got, want = weighed.first()["mean"], each.first()["mean"]
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    each = group_stats(repeated, ["k"], {"s": share("flag"), "m": F.median("m1")})
    once = group_stats(values, ["k"], {"s": share("flag", "served"), "m": F.percentile("m1", F.lit(0.5), F.col("served"))})
    assert found(once, "k", "s", "m") == found(each, "k", "s", "m")


def test_one_row_of_a_provider_that_a_source_names_twice_is_kept_in_each_county(spark, monkeypatch):
    area = spark.createDataFrame(ROWS, AREA)
    name = f"oe_{next(iter(scorecard.OUTCOMES))}_estimate"
    providers = [("000001", "TX", 2.0), ("000001", "TX", 1.0), ("000002", "TX", 3.0), (None, "TX", 5.0)]
    joined = spark.createDataFrame(providers, f"cms_certification_number_ccn string, state string, {name} double").coalesce(1)
    monkeypatch.setattr(scorecard, "joined_rows", lambda *_: joined)
    monkeypatch.setattr(scorecard, "add_flags", lambda df: df)
    monkeypatch.setattr(scorecard, "add_scores", lambda df: df)
    run = Held(service_area=area)
    rows = scorecard.score_rows(run, {}, "2001-08-01").where("kept").collect()
    assert sorted((r["County_ID"], r[name]) for r in rows) == [
        ("TX_A", 1.0), ("TX_A", 3.0), ("TX_A", 5.0), ("TX_B", 1.0), ("TX_C", 1.0)
    ]
    served = {(r["provider"]["cms_certification_number_ccn"], r["served"]) for r in run.bases["provider_values"].collect()}
    assert served == {("000001", 3), ("000002", 1), (None, 1)}


def test_wide_rows_are_not_left_to_an_interpreted_method(spark):
    before = spark.conf.get(METHOD_LIMIT[0])
    spark.conf.set(METHOD_LIMIT[0], "65535")
    try:
        with Run(spark):
            assert spark.conf.get(METHOD_LIMIT[0]) == METHOD_LIMIT[1] == "8000"
    finally:
        spark.conf.set(METHOD_LIMIT[0], before)


def test_six_places_are_those_of_round(spark):
    odd = [float("nan"), float("inf"), 0.0, -0.0, 1e300, 5e-7, 1.5e-6, 2.5e-6, -2.5e-6, 0.1234565, 999999.9999995, 123456789.1234567, None]
    numbers = spark.createDataFrame([(x,) for x in odd], "x double").union(
        spark.range(5000).select(((F.col("id") - 2500) * 0.5 + 0.5) / 1e6)
    ).union(spark.range(5000).select(F.col("id") / 7 * 1e3))
    assert numbers.where(~six_places(F.col("x")).eqNullSafe(F.round("x", 6))).count() == 0
