"""Ingest at size: lookups in a reading, landing files, the batch of a stream, tasks of the order check."""

import json
import re

from pyspark.sql import functions as F

from hebdo.operators import normalize as N
from hebdo.plans import q_admin, q_stream
from hebdo.sources import payloads as P
from hebdo.streaming import ingest as S

READINGS = [
    {"date": {"utc": " ", "UTC": "2024-01-02T00:00:00Z"}, "value": True, "parameter": {"name": "", "code": 7, "unit": "u"}},
    {"period": {"datetimeTo": {"iso": "2024-01-03"}, "end": "2024-01-09"}, "valueAvg": "9", "statistics": {"mean": None, "avg": 2.5}},
    {"date": "2024-01-04", "average": 1.25, "locationId": "12", "coordinates": {"longitude": "1.5", "latitude": 2}, "units": ""},
    {"window": {"end": "2024-01-05"}, "avg": 3, "location_id": 4.0, "longitude": 12345678901234567890, "parameter": "p"},
    5, None, {"date": None, "period": 3},
]


def _normalized(spark):
    page = json.dumps({"results": READINGS})
    return N.normalize_pm25(P.parse_pm25_pages(spark.createDataFrame([(1, page)], "sensor_id long, value string")))


def test_readings_of_odd_shapes(spark):
    got = [(r.date_utc and r.date_utc.day, r.value, r.units, r.parameter, r.location_id, r.longitude, r.latitude, r.reject_reason)
           for r in _normalized(spark).collect()]
    none = (None, None, None, None, None, None, None, "NO_TIMESTAMP")
    assert got == [(2, 1.0, "u", "7", None, None, None, None), (3, 2.5, None, None, None, None, None, None),
                   (4, 1.25, None, None, 12, 1.5, 2.0, None), (5, 3.0, None, "p", 4, 12345678901234567890.0, None, None),
                   none, none, none]


def test_a_reading_is_not_searched_path_by_path(spark):
    plan = _normalized(spark)._jdf.queryExecution().optimizedPlan().toString()
    lookups = {p for p in re.findall(r"\$\.(\w+),", plan) if p not in ("results", "data")}  # paths of one name
    assert not lookups, lookups


def test_one_landing_file_per_sensor(spark, tmp_path):
    pages = spark.range(60, numPartitions=6).select((F.col("id") % 5).alias("sensor_id"), F.lit("{}").alias("value"))
    q_stream.land_pages(pages, str(tmp_path / "landing"))
    assert len(list((tmp_path / "landing").rglob("part-*"))) == 5


def test_bounded_dedup_runs_the_batch_once(spark, tmp_path, monkeypatch):
    seen = []
    insert = S.insert_new
    monkeypatch.setattr(S, "insert_new", lambda s, path, rows, *a: (seen.append(rows.inputFiles()), insert(s, path, rows, *a)))
    events = spark.range(8).select(F.col("id").alias("event_id"), F.lit("2024-01-01").cast("timestamp").alias("ts"),
                                   (F.col("id") % 3).alias("user_id"), F.lit("a").alias("event_type"), F.lit(1.0).alias("value"),
                                   F.lit("x").alias("props"))
    S.land_events(events, f"{tmp_path}/landing", 1)
    S.stream_dedup_bounded(spark, f"{tmp_path}/landing", f"{tmp_path}/t", f"{tmp_path}/c", ["user_id", "event_type", "day"])
    assert seen and all("/staging/" in f for files in seen for f in files) and any(seen)


def test_tasks_of_the_order_check_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(q_admin, "ROWS_PER_TASK", 100)
    out = q_admin.q_clustered_table(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2
    assert out.filter("NOT in_order").isEmpty()
