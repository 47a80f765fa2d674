"""Jobs on hand-made inputs, one or more rows per decision on unclear cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gradewell.plans import allegations, certifications, date_ranges, deficiencies, service_area

ASOF = dt.date(2019, 7, 31)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Write rows as a table and read them back, so that sizes are known."""
    folder = tmp_path_factory.mktemp("inputs")
    made = iter(range(1000))

    def keep(rows, schema):
        place = str(folder / f"t{next(made)}.parquet")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(place)
        return spark.read.parquet(place)

    return keep


def test_deficiencies(store):
    health = store(
        [
            # Provider 1: the older survey is left out; 0 and missing tags give no finding.
            ("00001", "2018-01-01", "S", 100.0, "G"),
            ("00001", "2019-01-02", "S", 101.0, "G"),
            ("00001", "2019-01-02", "S", 167.0, "G"),
            ("00001", "2019-01-02", "S", 330.0, "G"),
            ("00001", "2019-01-02", "S", 0.0, "G"),
            ("00001", "2019-01-02", "S", None, "G"),
            # Provider 2: exactly 36 months back is outside, a day later inside.
            ("000002", "2016-07-31", "S", 117.0, "G"),
            ("000003", "2016-08-01", "S", 117.0, "G"),
            # Provider 4 has no address, provider 5 no county.
            ("000004", "2019-01-01", "S", 117.0, "G"),
            ("000005", "2019-01-01", "S", 117.0, "G"),
            # Future survey.
            ("000006", "2019-08-01", "S", 117.0, "G"),
        ],
        "PRVDR_CCN string, CLNDR_SRVY_DT_SK string, SRVY_CYC_CD string, TAG_NUM double, PREX_CD string",
    )
    complaints = store(
        [
            # The same tag on the same day in both cycles stays a standard finding.
            ("00001", "2019-01-02", "C", 101.0, "G"),
            ("00001", "2019-01-02", "C", 12345.0, "G"),
            ("00001", "2019-01-02", "C", 7.0, "G"),
            ("000003", "2018-01-31", "C", 150.0, "G"),
            ("000006", "2018-02-01", "C", 150.0, "G"),
        ],
        "PRVDR_CCN string, CLNDR_SRVY_DT_SK_10 string, SRVY_CYC_CD_4 string, TAG_NUM_15 double,"
        " PREX_CD_16 string",
    )
    survey = store(
        [(f"{i}", f"Home {i}", f"{i} Main St", "FL", "501" if i != 5 else "99999") for i in (1, 2, 3, 5, 6)],
        "`CMS Certification Number (CCN)` string, `Provider Name` string, Address string, State string,"
        " Zip string",
    )
    counties = store([("A", "00501"), ("B", "501")], "county string, zip_code string")
    rows = deficiencies.deficiency_rows(health, complaints, survey, counties, ASOF)
    got = sorted(
        (r["PRVDR_NUM"], r["SRVY_CYC_CD"], r["DFCNCY_TAG_NUM"], r["tagcount_lastsurv"], r["tagcount_complaint"])
        for r in rows.collect()
    )
    assert got == [
        ("000001", "Complaint", "G-0007", None, 1),
        ("000001", "Standard", "G-0101", 3, 1),
        ("000001", "Standard", "G-0167", 3, 1),
        ("000001", "Standard", "G-0330", 3, 1),
        ("000003", "Standard", "G-0117", 1, None),
        ("000006", "Complaint", "G-0150", None, 1),
    ]
    assert rows.first()["zip"] == "00501"
    summary = {r["PRVDR_NUM"]: r for r in deficiencies.deficiency_summary(rows).collect()}
    one = summary["000001"]
    assert (one["def_total"], one["def_patient_rights"], one["def_comp_assess"]) == (4, 1, 1)
    assert (one["DFCNCY_TAG_NUM"], one["comp_binary"], one["def_binary"]) == ("G-0007", 1, 1)
    assert summary["000003"]["comp_binary"] == 0 and summary["000006"]["def_org_admin"] == 1


def test_allegations(store):
    details = store(
        [
            ("00001", "2019-01-01", 11, 1),
            ("00001", "2019-05-01", 1, 1),
            ("00001", "2019-05-01", 1, 2),
            ("00001", "2019-05-01", 15, 1),
            ("00001", "2019-05-01", 20, None),
            ("00001", "2019-05-01", None, 1),
            ("00001", "2019-05-01", 30, 1),
            ("000002", "2018-01-31", 11, 1),
            ("000003", "2018-02-01", 11, None),
            ("000004", "bad", 11, 1),
        ],
        "PRVDR_CCN string, CLNDR_EXIT_DT_SK string, ALGTN_TYPE_CD int, ALGTN_FNDNG_CD int",
    )
    got = {r["PRVDR_NUM"]: r for r in allegations.latest_allegations(details, ASOF).collect()}
    assert set(got) == {"000001", "000003"}
    one = got["000001"]
    assert one["EXIT_DT"] == dt.date(2019, 5, 1)
    assert (one["alleg_total"], one["alleg_rows"], one["total_sub_alleg"]) == (3, 4, 3)
    assert (one["total_abu_neg_alleg"], one["total_staff_alleg"], one["total_rehosp_alleg"]) == (1, 2, 3)
    # The last row is type 30 with finding 1: weight 2, three such findings that day.
    assert (one["weight_flag"], one["total_weight_alleg"], one["sub_alleg_bin"]) == (2, 6, 1)
    three = got["000003"]
    assert (three["alleg_total"], three["weight_flag"], three["total_weight_alleg"]) == (0, 0, None)


def test_certifications(store):
    counts = ", ".join(f"{c} long" for c in certifications.PER_YEAR.values())

    def row(ccn, day, admits):
        return (ccn, day, day, admits, 2, 3, 4, 5, 6, 7, "dropped")

    rows = [
        # Unsorted on purpose. Provider 1: gap of one day, counts run from the one before.
        row("1", "2019-01-02", 73),
        row("1", "2018-01-01", 10),
        row("1", "2019-01-01", 20),
        # Provider 2 and 3: a short gap counts as a correction above 1,000 admissions only.
        row("2", "2019-02-20", 1001),
        row("2", "2019-01-01", 5),
        row("2", "2018-01-01", 5),
        row("3", "2019-02-20", 1000),
        row("3", "2019-01-01", 5),
        row("3", "2018-01-01", 5),
        row("4", "2019-01-01", 5),
        row("5", "2018-01-01", 5),
        row("5", "2019-01-01", 5),
        row("5", "2019-01-01", 6),
    ]
    table = store(
        rows,
        "PRVDR_CCN string, CLNDR_CRTFCTN_DT_SK string, CLNDR_CRTFCTN_UPDT_DT_SK string, "
        + counts
        + ", STATE_NAME string",
    )
    out = certifications.latest_certifications(table)
    assert "STATE_NAME" not in out.columns
    got = {r["PRVDR_NUM"]: r for r in out.collect()}
    days = {k: r["survey_days"] for k, r in got.items()}
    assert days == {"000001": 366, "000002": 415, "000003": 50, "000004": None, "000005": 0}
    one = got["000001"]
    assert one["CRTFCTN_DT"] == "20190102"
    assert one["census_undup_admit_per_year"] == pytest.approx(73 * 365 / 366)
    assert (one["pred_all_small_flag"], one["pred_lung_small_flag"]) == (0, 1)
    # No year to divide by: no rate, and no small-volume flag.
    for k in ("000004", "000005"):
        assert got[k]["census_undup_admit_per_year"] is None and got[k]["pred_CHF_small_flag"] == 0


def test_service_area_and_benchmark(spark, store):
    zips = store(
        [("501", "A"), ("501", "B"), ("00502", "A"), ("00502", "A")], "zip_code string, county string"
    )
    served = store(
        [("FL", "1", "501"), ("FL", "1", "502"), ("FL", "000002", "00501"), ("CA", "3", "999"), ("FL", "4", None)],
        "state string, cms_certification_number_ccn string, zip_code string",
    )
    got = sorted(
        (r["County_ID"], r["cms_certification_number_ccn"], r["zip_code"], r["County_count"])
        for r in service_area.service_area(served, zips).collect()
    )
    assert got == [
        ("FL_A", "000001", "00502", 2),
        ("FL_A", "000002", "00501", 2),
        ("FL_B", "000001", "00501", 2),
        ("FL_B", "000002", "00501", 2),
    ]
    rates = store([(b"10", 0.1), (b"11", 0.3), (b"12", 0.9), (b"13", 0.5)], "CCN binary, rate_adj double")
    facilities = store(
        [
            (b"10", dt.date(2018, 1, 1), b"CA"),
            (b"10", dt.date(2019, 1, 1), b"FL"),
            (b"10", None, b"NV"),
            (b"11", dt.date(2019, 1, 1), b"FL"),
            (b"13", dt.date(2019, 1, 1), b"CA"),
        ],
        "PROV_NUM binary, Survey_date date, STATE_ABBREV binary",
    )
    means = {r[0]: r[1] for r in service_area.state_benchmark(rates, facilities).collect()}
    assert means == {"FL": pytest.approx(0.2), "CA": pytest.approx(0.5)}


def test_date_ranges(store):
    raw = store(
        [
            ("How often, and when", "July 1, 2018 - June 30, 2019", 1),
            ("Average of all", "x", 2),
            ("With ulcers", "x", 3),
            ("within 31 days", "x", 4),
            ("average in lower case", "a, b", 5),
            (None, "x", 6),
        ],
        "`Measure Name` string, ` Measure (Date) Range` string, n int",
    )
    out = date_ranges.measure_date_ranges(raw)
    assert out.columns == ["measure_name", "measure_date_range"]
    assert sorted(map(tuple, out.collect())) == [
        ("How often; and when", "July 1; 2018 - June 30; 2019"),
        ("average in lower case", "a; b"),
    ]


def test_sums_of_flags_are_conserved(store):
    rows = store([(i % 3, i) for i in range(30)], "k int, v int")
    from gradewell.operators import groups

    out = groups.flag_totals(rows, ["k"], {"even": F.col("v") % 2 == 0}, "n").collect()
    assert sum(r["n"] for r in out) == 30 and sum(r["even"] for r in out) == 15
