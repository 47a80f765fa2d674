"""Hot keys must change no result."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradewell.operators import groups, joins, picks, ranks, spread
from limits import both, limits


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """600 rows; key 0 owns 400, a third of all rows are copies, keys and values have holes."""
    rng = np.random.default_rng(7)
    n = 600
    frame = pd.DataFrame(
        {
            "id": np.arange(n),
            "k": np.where(np.arange(n) < 400, 0, rng.integers(1, 9, n)).astype("float"),
            "v": np.where(np.arange(n) < 200, 5.0, rng.integers(0, 60, n) / 4.0),
            "day": rng.integers(0, 40, n),
            "flag": rng.integers(0, 2, n),
        }
    )
    frame.loc[::37, "k"] = np.nan
    frame.loc[::23, "v"] = np.nan
    place = str(tmp_path_factory.mktemp("skew") / "t.parquet")
    spark.createDataFrame(frame).select(
        "id",
        F.when(~F.isnan("k"), F.col("k").cast("int")).alias("k"),
        F.when(~F.isnan("v"), F.col("v")).alias("v"),
        "day",
        "flag",
    ).repartition(6).write.parquet(place)
    return spark.read.parquet(place), frame


def by_id(df, *cols):
    return {r["id"]: tuple(r[c] for c in cols) for r in df.select("id", *cols).collect()}


def close(a, b):
    return a.keys() == b.keys() and all(
        all((x is None) == (y is None) and (x is None or x == pytest.approx(y)) for x, y in zip(a[i], b[i]))
        for i in a
    )


def test_pct_rank_matches_pandas_on_both_paths(spark, skewed):
    df, frame = skewed
    want = frame.groupby("k")["v"].rank(pct=True) * 100
    for out in both(spark, lambda: ranks.attach_pct_rank(df, ["k"], {"r": "v"}, rounded=False)):
        got = by_id(out, "r")
        assert len(got) == len(frame)
        for i in frame["id"]:
            assert (got[i][0] is None) == np.isnan(want[i])
            assert np.isnan(want[i]) or got[i][0] == pytest.approx(want[i])


def test_pct_rank_by_row_key(spark, skewed):
    df, _ = skewed
    measures = {"r1": "v", "r2": "day"}

    def keyed():
        ranked = ranks.rank_rows(df, "id", ["k"], measures, rounded=False)
        return df.select("id").join(ranked, "id", "left")

    with limits(spark, rows=10**9):
        windows = ranks.attach_pct_rank(df, ["k"], measures, rounded=False)
    plain, forced = both(spark, keyed)
    want = by_id(windows, "r1", "r2")
    assert close(want, by_id(plain, "r1", "r2"))
    assert close(want, by_id(forced, "r1", "r2"))


def test_rounded_gated_ranks_of_several_measures(spark, skewed):
    df, _ = skewed
    sized = groups.attach(df, ["k"], {"n": F.count("id")})
    measures = {"r1": "v", "r2": "day"}
    plain, forced = both(
        spark, lambda: ranks.attach_pct_rank(sized, ["k"], measures, min_size=("n", 30))
    )
    assert close(by_id(plain, "r1", "r2"), by_id(forced, "r1", "r2"))
    assert any(v[0] is None for v in by_id(plain, "r1").values())


def test_median_matches_pandas_on_both_paths(spark, skewed):
    df, frame = skewed
    want = frame.groupby("k")[["v", "day"]].median()
    for out in both(spark, lambda: ranks.attach_median(df, ["k"], {"m": "v", "d": "day"})):
        got = by_id(out, "k", "m", "d")
        assert len(got) == len(frame)
        for k, m, d in got.values():
            if k is None:
                assert m is None and d is None
            else:
                assert (m, d) == (want["v"][k], want["day"][k])


@pytest.mark.parametrize("steps", [1, 2, 3])
def test_lag_across_segments(spark, skewed, steps):
    df, _ = skewed
    lags = {"p": ("day", 1), "q": ("v", steps)}
    plain, forced = both(spark, lambda: ranks.attach_lag(df, "k", ["day", "id"], lags))
    assert by_id(plain, "p", "q") == by_id(forced, "p", "q")
    assert len(by_id(forced, "p")) == 600


def test_attach_on_both_paths(spark, skewed):
    df, _ = skewed
    aggs = {"s": groups.total("v"), "c": F.count("v"), "r": groups.share("flag")}
    plain, forced = both(spark, lambda: groups.attach(df, ["k"], aggs))
    got = by_id(forced, "k", "s", "c", "r")
    assert close(by_id(plain, "k", "s", "c", "r"), got) and len(got) == 600
    assert all(v[1:] == (None, None, None) for v in got.values() if v[0] is None)


def test_hot_rows_are_spread_and_none_is_lost(spark, skewed):
    df, _ = skewed
    right = df.groupBy("k").agg(F.max("v").alias("top"))
    with limits(spark):
        hot = spread.directory(df, ["k"])
        left = joins.lookup_join(df, right, ["k"], "left").count()
        inner = joins.lookup_join(df, right, ["k"], "inner").count()
    salts = hot[("k",)]
    zero = df.where("k = 0").select(spread.key_hash(["k"]).alias("h")).first()["h"]
    assert salts[zero] >= 70 and all(n >= 2 for n in salts.values())
    assert left == df.count()
    assert inner == df.where("k is not null").count()


def test_rows_of_latest_keeps_all_ties(spark, skewed):
    df, frame = skewed
    want = set(frame.loc[frame["day"] == frame.groupby("k")["day"].transform("max"), "id"])
    for out in both(spark, lambda: picks.rows_of_latest(df, "k", "day")):
        assert {r["id"] for r in out.collect()} == want


def test_star_join_counts_on_the_base(spark, skewed):
    df, _ = skewed
    dim = df.where("k is not null").groupBy("k").agg(F.min("id").alias("owner"))
    names = df.select(F.col("id").alias("owner"), F.col("day").alias("owner_day"))
    sides = [(dim, ["k"]), (names, ["owner"])]
    plain, forced = both(spark, lambda: joins.star_join(df, sides))
    assert by_id(plain, "owner", "owner_day") == by_id(forced, "owner", "owner_day")
    assert forced.count() == 600


def test_reduce_join_on_both_paths(spark, skewed):
    df, _ = skewed
    known = df.where("k is not null")
    sides = [known] + [
        groups.group_stats(known, ["k"], {n: F.max(c)}) for n, c in (("a", "v"), ("b", "day"))
    ]
    plain, forced = both(spark, lambda: joins.reduce_join(sides, ["k"]))
    assert by_id(plain, "a", "b") == by_id(forced, "a", "b")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5]))),
        min_size=1,
        max_size=25,
    )
)
def test_rank_is_within_range_and_independent_of_partitions(spark, rows):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "id int, k int, v double")

    def rank(frame):
        return by_id(ranks.attach_pct_rank(frame, ["k"], {"r": "v"}, rounded=False), "r")

    with limits(spark, rows=10**9):
        one, many = rank(df.coalesce(1)), rank(df.repartition(5))
    with limits(spark, rows=1):
        forced = rank(df)
    assert one == many and close(one, forced)
    assert all(v[0] is None or 0 < v[0] <= 100 for v in one.values())
