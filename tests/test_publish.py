"""The published extracts, written and read back."""

import os

import pytest
from gradewell.plans import date_ranges, deficiencies, scorecard
from gradewell.run import Run
from gradewell.session import shared_folder
from gradewell.sources.tables import read_csv
from gradewell.specs.publish import NETWORK_COLUMNS, SCORECARD_COLUMNS, STATES
from querybook.inputs import ASOF, derived, derived_tables
from querybook.jobs import finding_rows


def folders(path):
    return {d.removeprefix("by_state=") for d in os.listdir(path) if d.startswith("by_state=")}


def test_scorecard_extracts(spark, folder, tmp_path):
    tables = derived_tables(spark, folder)
    before = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    kept = Run(spark)
    full = scorecard.full_table(tables, ASOF, kept)
    wanted = full.where(full.state.isin(*STATES)).count()
    assert {"scored", "graded", "quality", "survey"} <= set(kept.names)
    scorecard.publish(kept, full, str(tmp_path))
    kept.close()
    # One run made both extracts, and nothing of it is left.
    assert {r.namespace for r in spark.sql("SHOW DATABASES").collect()} == before
    assert not os.path.exists(f"{shared_folder(spark).removeprefix('file:')}/{kept.database}")
    for name, columns in (("scorecard", SCORECARD_COLUMNS), ("network", NETWORK_COLUMNS)):
        place = str(tmp_path / name)
        assert folders(place) == set(STATES)
        back = read_csv(spark, place)
        assert back.count() == wanted
        assert [c for c in back.columns if c != "by_state"] == columns
    assert back.where("CMS_ID NOT LIKE \"'%\"").count() == 0


def test_a_run_makes_each_base_once_and_removes_all_after_an_error(spark):
    made = []

    def build():
        made.append(1)
        return spark.range(5)

    with pytest.raises(ZeroDivisionError), Run(spark) as run:
        assert run.base("five", build).count() == run.base("five", build).count() == 5
        raise ZeroDivisionError
    assert made == [1]
    assert run.database not in {r.namespace for r in spark.sql("SHOW DATABASES").collect()}


def test_finding_and_date_range_exports(spark, folder, tmp_path):
    rows = finding_rows(spark, folder)
    deficiencies.export_rows(rows, str(tmp_path / "findings"))
    assert folders(tmp_path / "findings") <= set(STATES)
    published = rows.where(rows.state.isin(*STATES)).count()
    assert read_csv(spark, str(tmp_path / "findings")).count() == published > 0
    ranges = spark.createDataFrame([("a, b", "c"), ("Average", "d")], "measure_name string, measure_date_range string")
    date_ranges.export_date_ranges(ranges, str(tmp_path / "ranges"))
    got = [tuple(r) for r in read_csv(spark, str(tmp_path / "ranges")).collect()]
    assert got == [("a; b", "c")]
    assert derived(spark, folder, "zip_county").columns[0] == "zip_code"
