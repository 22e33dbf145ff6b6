"""Hand-written golden rows (FIXTURES.md section C)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hebdo.functions import calendar as cal
from hebdo.functions import flags
from hebdo.functions.text import normalize_timestamp_text
from hebdo.operators import gaps, normalize as N, upsert as up
from hebdo.sources import dims, payloads as P


def _texts(spark, values, name="value"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("text,expected", [
    ("2024-01-01", "2024-01-01T00:00:00Z"),
    ("2024-01-01T08:00:00", "2024-01-01T08:00:00Z"),
    ("2024-01-01T00:00:00-08:00", "2024-01-01T00:00:00-08:00"),
    ("  ", None),
    ("2024-01-01 05:00:00", "2024-01-01 05:00:00T00:00:00Z"),
])
def test_normalize_timestamp_text(spark, text, expected):
    got = _texts(spark, [text]).select(normalize_timestamp_text(F.col("value")).alias("t")).first().t
    assert got == expected


def _pm25(spark, row: dict, sensor=1):
    page = json.dumps({"meta": {"found": 1}, "results": [row]})
    pages = spark.createDataFrame([(sensor, page)], "sensor_id bigint, value string")
    return N.normalize_pm25(P.parse_pm25_pages(pages)).collect()


def test_offset_instant(spark):
    r = _pm25(spark, {"date": "2024-01-01T00:00:00-08:00", "value": 1})[0]
    assert r.date_utc == dt.datetime(2024, 1, 1, 8, 0) and r.reject_reason is None


def test_malformed_timestamp_is_quarantined(spark):
    r = _pm25(spark, {"date": "2024-01-01 05:00:00", "value": 1})[0]
    assert r.reject_reason == "BAD_TIMESTAMP"


def test_period_to_before_from(spark):
    r = _pm25(spark, {"period": {"datetimeFrom": {"utc": "2024-01-01T08:00:00Z"},
                                 "datetimeTo": {"utc": "2024-01-02T08:00:00Z"}}})[0]
    assert r.date_utc == dt.datetime(2024, 1, 2, 8, 0)


def test_date_local_before_direct_utc(spark):
    r = _pm25(spark, {"date": {"local": "2024-01-01"}, "utc": "2024-01-05"})[0]
    assert r.date_utc == dt.datetime(2024, 1, 1)


def test_no_timestamp_dropped(spark):
    r = _pm25(spark, {"value": 1})[0]
    assert r.reject_reason == "NO_TIMESTAMP"


@pytest.mark.parametrize("row,expected", [
    ({"value": "7.5", "avg": 3}, 3.0),
    ({"value": True}, 1.0),
    ({"statistics": {"mean": 4.5}}, 4.5),
    ({"value": "7.5"}, None),
])
def test_value_pick(spark, row, expected):
    row = {"date": "2024-01-01", **row}
    assert _pm25(spark, row)[0].value == expected


def test_units_parameter_location(spark):
    r = _pm25(spark, {"date": "2024-01-01", "units": "", "parameter": {"unit": "ug/m3"}})[0]
    assert r.units == "ug/m3"
    r = _pm25(spark, {"date": "2024-01-01", "parameter": {"name": "", "code": "pm25"}})[0]
    assert r.parameter == "pm25"
    r = _pm25(spark, {"date": "2024-01-01", "location_id": 0, "locationId": "42"})[0]
    assert r.location_id == 42
    r = _pm25(spark, {"date": "2024-01-01", "location_id": "12.5"})[0]
    assert r.location_id is None
    r = _pm25(spark, {"date": "2024-01-01", "location_id": 12.7})[0]
    assert r.location_id == 12
    r = _pm25(spark, {"date": "2024-01-01", "coordinates": {"latitude": "36.5", "longitude": -119}})[0]
    assert (r.latitude, r.longitude) == (36.5, -119.0)


def test_pages_results_else_data(spark):
    docs = [json.dumps({"results": [], "data": [{"date": "2024-01-01"}, {"date": "2024-01-02"}]}),
            json.dumps({"results": [{"date": "2024-01-03"}], "data": [{"date": "2024-01-04"}]}),
            json.dumps({"meta": {}}), "not json"]
    pages = spark.createDataFrame([(1, d) for d in docs], "sensor_id bigint, value string")
    rows = P.parse_pm25_pages(pages)
    assert rows.filter("page_error IS NULL").count() == 3
    assert rows.filter("page_error = 'NOT_JSON'").count() == 1


def test_weather_arrays(spark):
    docs = [json.dumps({"request": {"point_id": "p"}, "daily": {"time": ["2024-01-01"]}}),
            json.dumps({"request": {"point_id": "q"}, "daily": {}}),
            json.dumps({"request": {"point_id": "r"}, "daily": {"time": ["2024-01-01", "2024-01-02"],
                                                                 "temperature_2m_max": [1.0]}})]
    out = N.normalize_weather(N.explode_weather(P.parse_weather_payloads(_texts(spark, docs)))).collect()
    p = [r for r in out if r.point_id == "p"]
    assert len(p) == 1 and p[0].temp_min is None and p[0].temp_max is None and p[0].temp_mean is None
    assert not [r for r in out if r.point_id == "q"]
    assert {r.reject_reason for r in out if r.point_id == "r"} == {"ARRAY_LENGTH_MISMATCH"}


def test_flu_envelopes(spark):
    docs = [json.dumps({"result": -2, "message": "no results"}),
            json.dumps({"request": {"region": "ca", "chunk_start": 202101, "chunk_end": 202110},
                        "result": 1, "epidata": [{"epiweek": "abc", "wili": 1},
                                                 {"epiweek": 202102, "wili": "1.5"},
                                                 {"epiweek": 202120, "wili": 2}]}),
            json.dumps({"request": {"region": "ca", "chunk_start": 202550, "chunk_end": 202553},
                        "result": 1, "epidata": [{"epiweek": 202553}]})]
    records, errors = P.parse_flu_payloads(_texts(spark, docs))
    assert errors.first().message == "no results"
    out = N.normalize_flu(records).collect()
    good = [r for r in out if r.reject_reason is None]
    assert [(r.epiweek, r.wili, r.week_start) for r in good] == [(202102, 1.5, dt.date(2021, 1, 11))]
    assert [r.reject_reason for r in out if r.epiweek == 202553] == ["INVALID_EPIWEEK"]


def test_epiweeks(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3), 202101, 202553, 202053)], "d date, a bigint, b bigint, c bigint")
    r = df.select(cal.epiweek(F.col("d")).alias("e"), cal.epiweek_monday(F.col("a")).alias("m"),
                  cal.epiweek_monday(F.col("b")).alias("bad"), cal.epiweek_add(F.col("c"), 1).alias("n")).first()
    assert (r.e, r.m, r.bad, r.n) == (202053, dt.date(2021, 1, 4), None, 202101)


def test_week_chunks(spark):
    ranges = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 1) + dt.timedelta(weeks=59))],
                                   "range_start date, range_end date")
    lengths = [r.chunk_weeks for r in gaps.chunk_weeks(ranges, 26).orderBy("chunk_start").collect()]
    assert lengths == [26, 26, 8]
    with pytest.raises(ValueError):
        gaps.chunk_weeks(ranges, 0)


def test_month_windows(spark):
    r = spark.createDataFrame([("x", dt.date(2022, 1, 15), dt.date(2022, 3, 10))], "e string, start date, end date")
    got = [(w.window_start, w.window_end) for w in gaps.month_windows(r, ["e"]).orderBy("window_start").collect()]
    assert got == [(dt.date(2022, 1, 15), dt.date(2022, 1, 31)), (dt.date(2022, 2, 1), dt.date(2022, 2, 28)),
                   (dt.date(2022, 3, 1), dt.date(2022, 3, 10))]


def test_dedup_null_release_wins(spark):
    df = spark.createDataFrame([("ca", 1, dt.datetime(2024, 1, 1), 1, 1.0), ("ca", 1, dt.datetime(2024, 2, 1), 2, 2.0),
                                ("ca", 1, None, 3, 3.0)], "region string, ew int, release_date timestamp, ingest_seq int, v double")
    assert up.dedup_latest(df, ["region", "ew"]).first().v == 3.0


def test_upsert_overwrites_with_null(spark):
    t = spark.createDataFrame([(1, 5.0), (2, 6.0)], "k int, v double")
    s = spark.createDataFrame([(1, None), (3, 7.0), (None, 8.0)], "k int, v double")
    got = dict((r.k, r.v) for r in up.upsert(t, s, ["k"]).collect())
    assert got == {1: None, 2: 6.0, 3: 7.0}
    with pytest.raises(Exception, match="several rows for key k=1"):
        up.upsert(t, s.filter("k = 1").unionByName(s.filter("k = 1")), ["k"]).collect()


def test_control_strings(spark):
    df = spark.createDataFrame([(1, "1, 22 abc3 22 007 7"), (2, "1,2;bad;3,x;4,5,,N"), (3, ""),
                                (4, " CA ,, state:ca")], "id int, t string")
    ids = [r.sensor_id for r in dims.sensor_ids(df.filter("id = 1"), "t", ["id"]).orderBy("position").collect()]
    assert ids == [1, 22, 7]
    pts = [(p.lat, p.lon, p.point_id, p.region_label) for p in dims.points(df.filter("id = 2"), "t", ["id"]).collect()]
    assert pts == [(1.0, 2.0, "sj", "CA"), (4.0, 5.0, "la", "N")]
    assert dims.points(df.filter("id = 3"), "t", ["id"]).count() == 6
    regs = [r.region for r in dims.regions(df.filter("id = 4"), "t", ["id"]).orderBy("position").collect()]
    assert regs == ["ca", "state:ca"]


def test_flags(spark):
    df = spark.createDataFrame([(2.0, None), (2.0, 0)], "x double, n bigint")
    got = df.select(flags.flu_flag(F.col("x"), F.col("n")).alias("f"),
                    flags.flu_stderr(F.col("x"), F.col("n")).alias("e")).collect()
    assert [(r.f, r.e) for r in got] == [("VALID", None), ("LOW_SAMPLE_SIZE", None)]
    vals = [12.0, 12.1, 35.4, 55.4, 150.4, 250.4, 250.5]
    bands = spark.createDataFrame([(v,) for v in vals], "m double").select(flags.aq_band(F.col("m")).alias("b"))
    assert [r.b for r in bands.collect()] == ["Good", "Moderate", "Moderate", "Unhealthy for Sensitive",
                                              "Unhealthy", "Very Unhealthy", "Hazardous"]


def test_first_nonblank_and_day_counts(spark):
    from hebdo.functions.text import first_nonblank
    df = spark.createDataFrame([(None, "  ", " x ", "y")], "a string, b string, c string, d string")
    assert df.select(first_nonblank(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("f")).first().f == "x"
    r = spark.range(1).select(cal.days_inclusive(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 31))).alias("n")).first()
    assert r.n == 31
    ranges = spark.createDataFrame([("2024-01-03", "2024-01-10"), ("2024-01-10", "2024-01-03"), (None, "2024-01-03")],
                                   "s string, e string").select(F.col("s").try_cast("date").alias("s"), F.col("e").try_cast("date").alias("e"))
    start, end, status = cal.resolve_range_cols(F.col("s"), F.col("e"), align_monday=True)
    got = ranges.select(start.alias("start"), end.alias("end"), status.alias("status")).collect()
    assert tuple(got[0]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 8), "OK")
    assert [r.status for r in got] == ["OK", "END_BEFORE_START", "INVALID_START"]


@pytest.mark.parametrize("text,value", [("12", 12.0), (" -1.5e3 ", -1500.0), (".5", 0.5), ("1d", None), ("2f", None),
                                        ("12D", None), ("", None), ("x", None), ("1e400", float("inf"))])
def test_numbers_without_type_suffixes(spark, text, value):
    from hebdo.functions.text import try_number
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(try_number(F.col("t")).alias("d")).first().d == value


def test_means_are_rounded_once(spark):
    from hebdo.operators.analytics import season_means
    df = spark.createDataFrame([("Winter", 1.0049999999996, 1.0, 1.0)], "season string, illness_rate double, pm25_avg double, temp_avg_celsius double")
    assert season_means(df).first().avg_illness_rate == 1.0
