"""Scores are made once per provider and state, whatever the number of counties."""

import pytest

from gradewell.plans import scorecard

AREA = "state string, cms_certification_number_ccn string, county string, County_ID string, zip_code string, County_count long"
ROWS = [
    ("TX", "000001", "A", "TX_A", "1", 2),
    ("TX", "000001", "B", "TX_B", "2", 1),
    ("TX", "000002", "A", "TX_A", "1", 2),
    (None, "000003", "A", None, "1", None),
    ("TX", None, "A", "TX_A", "1", 2),
    ("TX", "000001", "C", "TX_C", "3", 1),
]


class Held:
    """A run that writes nothing."""

    def __init__(self, **bases):
        self.bases = bases

    def base(self, name, build):
        if name not in self.bases:
            self.bases[name] = build()
        return self.bases[name]


class Stopped(Exception):
    pass


@pytest.fixture
def area(spark):
    return spark.createDataFrame(ROWS, AREA)


def test_the_provider_tables_join_one_row_per_provider_and_state(area, monkeypatch):
    bases = []

    def star_join(base, sides):
        bases.append(base)
        raise Stopped

    monkeypatch.setattr(scorecard, "star_join", star_join)
    side = area.withColumnRenamed("county", "STATE_ABBREV")
    names = ["certifications", "state_benchmark", "quality", "survey", "deficiencies", "allegations"]
    run = Held(service_area=area, **dict.fromkeys(names, side))
    with pytest.raises(Stopped):
        scorecard.joined_rows(run, {}, "2001-08-01")
    assert sorted(map(tuple, bases[0].collect()), key=str) == sorted({(r[1], r[0]) for r in ROWS}, key=str)


def test_scores_come_to_every_county_also_where_a_key_is_missing(spark, area, monkeypatch):
    providers = [("000001", "TX", 1.0), ("000001", "TX", 2.0), ("000002", "TX", 3.0), ("000003", None, 4.0), (None, "TX", 5.0)]
    name = f"oe_{next(iter(scorecard.OUTCOMES))}_estimate"
    joined = spark.createDataFrame(providers, f"cms_certification_number_ccn string, state string, {name} double")
    monkeypatch.setattr(scorecard, "joined_rows", lambda *_: joined)
    monkeypatch.setattr(scorecard, "add_flags", lambda df: df)
    monkeypatch.setattr(scorecard, "add_scores", lambda df: df)
    out = scorecard.score_rows(Held(service_area=area), {}, "2001-08-01")
    want = sorted(((r[1], r[0], r[3], p[2]) for r in ROWS for p in providers if p[:2] == (r[1], r[0])), key=str)
    got = out.select("cms_certification_number_ccn", "state", "County_ID", name).collect()
    assert sorted(map(tuple, got), key=str) == want
    assert out.select("row_id").distinct().count() == len(want)
