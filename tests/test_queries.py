"""Every registered query beside its SQL."""

import pytest

import querybook
from compare import connect, difference
from limits import limits

QUERIES, SQL = querybook.queries(), querybook.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, con, name):
    got = QUERIES[name](spark, folder).toPandas()
    assert len(got) > 0
    if name in SQL:
        assert difference(got, con.execute(SQL[name]).df()) is None


FORCED = [
    "attach_median",
    "attach_other_cycle_count",
    "attach_sum",
    "deficiency_summary_table",
    "fanout_dedup",
    "group_rate",
    "lag_gap",
    "letter_grade",
    "pct_rank_avg",
    "rows_of_latest_date",
    "scorecard_table",
    "service_area_table",
    "star_left_join",
]


@pytest.mark.parametrize("name", FORCED)
def test_large_input_path_equals_sql(spark, folder, con, name):
    with limits(spark, rows=15):
        got = QUERIES[name](spark, folder).toPandas()
    assert difference(got, con.execute(SQL[name]).df()) is None


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["c_custkey", "clamped", "mean_bal"] and df.count() > 0
