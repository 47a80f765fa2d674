"""Edge values of the column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gradewell.functions import dates, flags, numbers, scoring, text
from gradewell.operators import columns, filters
from gradewell.specs.models import OUTCOMES
from gradewell.specs.rules import RULES
from gradewell.specs.tags import TAG_LISTS


def values(spark, rows, schema, **exprs):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*[c.alias(n) for n, c in exprs.items()]).collect()]


def test_text(spark):
    rows = [("12345", "O'NEIL"), ("123456", "anne-marie SMITH"), ("1234567", "3rd é ÉCOLE"), (None, None)]
    got = values(spark, rows, "c string, n string", p=text.pad_code("c", 6), t=text.title("n"))
    assert got == [
        ("012345", "O'Neil"),
        ("123456", "Anne-Marie Smith"),
        ("1234567", "3Rd É École"),
        (None, None),
    ]


def test_tag_code(spark):
    rows = [(n,) for n in (None, 0.0, 1.0, 22.0, 333.0, 4444.0, 55555.0)]
    got = values(spark, rows, "n double", t=text.tag_code(F.lit("G"), "n"))
    assert [g[0] for g in got] == [None, None, "G-0001", "G-0022", "G-0333", "G-4444", None]


def test_street_words_and_stems(spark):
    got = values(
        spark,
        [("12 n. main st", "/a/b/Name.x.csv"), ("first boulevard", r"C:\d\N.csv")],
        "s string, f string",
        w=F.array_join(text.street_words("s"), " "),
        f=text.file_stem("f"),
    )
    assert got == [("12 NORTH MAIN STREET", "Name"), ("1ST BLVD", "N")]


def test_lookback_is_half_open_and_clamps(spark):
    rows = [("2025-02-28",), ("2025-03-01",), ("2026-08-31",), ("2026-09-01",), (None,)]
    day = F.col("d").cast("date")
    got = values(spark, rows, "d string", x=dates.in_lookback(day, dt.date(2026, 8, 31), 18))
    assert [g[0] for g in got] == [False, True, True, False, None]


def test_dates(spark):
    rows = [("2020-03-07", "3/7/2020"), ("20200307", "03/07/2020"), ("bad", "2020-03-07"), (None, None)]
    got = values(
        spark, rows, "c string, u string",
        c=dates.compact_date("c"), u=dates.us_date("u"), m=dates.year_month("u"),
    )
    day = dt.date(2020, 3, 7)
    assert got == [(day, day, "2020-3"), (day, day, "2020-3"), (None, None, None), (None, None, None)]
    assert values(spark, [(1,)], "i int", m=dates.reporting_month("2026-10-05")) == [("2026/10",)]


def test_numbers(spark):
    rows = [(1.0, 0.0, "7.5"), (1.0, 4.0, "Not Available"), (None, 2.0, None)]
    got = values(
        spark, rows, "a double, b double, t string",
        r=numbers.ratio("a", "b"), m=numbers.row_mean("a", "b"), n=numbers.to_number("t"),
        i=numbers.to_int_text("a"),
    )
    assert got == [(None, 0.5, 7.5, "1"), (0.25, 2.5, None, "1"), (None, None, None, "0")]


def test_nan_becomes_null_before_flags(spark):
    df = spark.createDataFrame([(float("nan"), 1), (90.0, 2), (None, 3)], "m_qm_timely_manner double, i int")
    rules = [r for r in RULES if r.column == "m_qm_timely_manner"]
    got = numbers.drop_nan(df).withColumns(flags.rule_flags(rules)).collect()
    assert all(r["qm_timely_manner_high_binary"] == 0 for r in got)


def test_every_break_closes_its_bin_on_the_right(spark):
    for outcome in OUTCOMES.values():
        rows = []
        for i, b in enumerate(outcome.breaks):
            rows += [(b, 5.0 * (i + 1)), (b + 1e-9, 5.0 * (i + 2)), (b - 1e-9, 5.0 * (i + 1))]
        rows.append((None, 0.0))
        got = values(
            spark, rows, "d double, want double", b=scoring.bin_by("d", outcome.breaks), w=F.col("want")
        )
        assert [g[0] for g in got] == [g[1] for g in got]


def test_every_step(spark):
    for outcome in OUTCOMES.values():
        rows = [(0.0, outcome.steps[0][1]), (100.0, outcome.last_step)]
        following = [v for _, v in outcome.steps[1:]] + [outcome.last_step]
        for (top, value), after in zip(outcome.steps, following):
            rows += [(float(top), value), (top + 0.5, after)]
        step = scoring.step_map("p", outcome.steps, outcome.last_step)
        got = values(spark, rows, "p double, want double", e=step, w=F.col("want"))
        assert [g[0] for g in got] == [g[1] for g in got]


def test_letters(spark):
    rows = [(p, s) for p in (9.9, 10.0, 25.0, 75.0, 90.0, 100.0, None) for s in (0, 1)]
    letter = scoring.letter_grade("p")
    got = values(
        spark, rows, "p double, s int",
        c=scoring.clamp_letter(letter, "s"), o=scoring.letter_grade("p", closed_top=False),
        h=scoring.shrink("p", "s"),
    )
    assert [g[0] for g in got] == ["A", "B", "B", "B", "C", "C", "D", "D", "E", "D", "E", "D", "N/A", "N/A"]
    assert [g[1] for g in got][-4:] == ["N/A"] * 4
    assert got[1][2] == pytest.approx(29.95) and got[0][2] == 9.9


def test_decode_contains_last_rule_wins(spark):
    rules = [("Non - Profit", "Non-Profit"), ("Government", "Government"), ("Proprietary", "For-Profit")]
    rows = [("Government Proprietary",), ("Non - Profit",), (None,), ("x",)]
    got = values(spark, rows, "o string", l=flags.decode_contains("o", rules, "N/A"))
    assert [g[0] for g in got] == ["For-Profit", "Non-Profit", "N/A", "N/A"]
    assert values(spark, rows, "o string", y=flags.yes_no("o", "x"))[2:] == [("Yes",), ("No",)]


def test_tag_lists_have_no_overlap_and_keep_their_gaps():
    tags = [t for tags in TAG_LISTS.values() for t in tags]
    assert len(tags) == len(set(tags)) == 175
    assert not {"G-0167", "G-0234", "G-0323"} & set(tags)


def test_columns(spark):
    df = spark.createDataFrame([(1, "a|b", None), (2, "c", "x, y"), (3, None, "z")], "id int, t string, u string")
    parts = columns.split_explode(df, "t", "|", keep=True).select("id", "t").collect()
    assert sorted(map(tuple, parts)) == [(1, "a"), (1, "a|b"), (1, "b"), (2, "c")]
    assert columns.header_name(" Risk (of) Falling, now ") == "risk_of_falling_now"
    kept = filters.exclude_matching(df, "u", ["x", "q.*"]).collect()
    assert sorted(r["id"] for r in kept) == [1, 3]
    filled = columns.fill_defaults(df, {"id": 0, "u": "N/A"}).collect()
    assert filled[0]["u"] == "N/A"
    union = columns.union_all([df.select("id"), df.select("u", "t")])
    assert union.columns == ["id", "t", "u"] and union.count() == 6
