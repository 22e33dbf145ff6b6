"""Sinks: staged file upsert, table evolution and descriptions, stream restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hebdo.operators import upsert as up
from hebdo.session import scratch_path, unique_suffix
from hebdo.sources import snapshots
from hebdo.sources import tables as T
from hebdo.streaming import ingest as S


SCHEMA = "date date, point_id string, temp double"


def _table(spark, rows, schema=SCHEMA):
    path = scratch_path(spark, "test", f"target-{unique_suffix()}")
    snapshots.create(spark.createDataFrame(rows, schema), path, ["date", "point_id"], "date")
    return path


def test_write_upsert_keeps_what_the_source_does_not_hold(spark):
    path = _table(spark, [(dt.date(2024, 1, d), f"p{k}", float(d * 10 + k)) for d in (1, 2, 3) for k in (1, 2)])
    src = spark.createDataFrame([(dt.date(2024, 1, 2), "p1", None), (dt.date(2024, 1, 4), "p9", 1.0)], SCHEMA)
    n = up.write_upsert(spark, path, src, ["date", "point_id"], "date")
    assert n == 2
    got = {(r.date, r.point_id): r.temp for r in snapshots.read(spark, path).collect()}
    assert got[(dt.date(2024, 1, 2), "p1")] is None            # overwritten with NULL
    assert got[(dt.date(2024, 1, 2), "p2")] == 22.0            # untouched key of a touched partition
    assert got[(dt.date(2024, 1, 4), "p9")] == 1.0             # inserted
    assert len(got) == 7


def test_write_upsert_of_nothing(spark):
    path = _table(spark, [(dt.date(2024, 1, 1), "p", 1.0)])
    assert up.write_upsert(spark, path, spark.createDataFrame([], SCHEMA), ["date", "point_id"], "date") == 0
    assert snapshots.read(spark, path).count() == 1 and snapshots.versions(spark, path) == [0]


def test_write_upsert_counts_and_stamps(spark):
    path = scratch_path(spark, "test", f"target-{unique_suffix()}")
    first = spark.createDataFrame([(dt.date(2024, 1, 1), "a", 1.0), (dt.date(2024, 1, 1), None, 2.0)], SCHEMA)
    stamp = {"inserted_at": F.current_timestamp()}
    assert up.write_upsert(spark, path, first, ["date", "point_id"], "date", stamp=stamp) == 1  # a NULL key is skipped
    again = spark.createDataFrame([(dt.date(2024, 1, 1), "b", 1.0), (dt.date(2024, 1, 2), "a", 1.0)], SCHEMA)
    assert up.write_upsert(spark, path, again, ["date", "point_id"], "date", stamp=stamp) == 2
    rows = snapshots.read(spark, path).collect()
    assert len(rows) == 3 and all(r.inserted_at is not None for r in rows)
    twice = again.union(again)
    with pytest.raises(up.DuplicateSourceKeys):
        up.write_upsert(spark, path, twice, ["date", "point_id"], "date", stamp=stamp)
    assert snapshots.read(spark, path).count() == 3


def test_upsert_fails_on_a_second_row_of_a_key(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(2, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="several rows for key k=2"):
        up.upsert(t, s, ["k"]).collect()


def test_merge_counts(spark):
    t = spark.createDataFrame([(1,), (2,)], "k int")
    s = spark.createDataFrame([(2,), (3,), (None,)], "k int")
    r = up.merge_counts(t, s, ["k"]).first()
    assert (r.updated, r.inserted, r.affected) == (1, 1, 2)


def test_ensure_table_evolution_and_conflict(spark):
    db = f"t_{unique_suffix().replace('-', '_')}"
    T.ensure_layer(spark, db, "test layer")
    name = f"{db}.w"
    v1 = T.schema_from_fields([("date", "DATE", True), ("temp", "FLOAT64", False)])
    assert T.ensure_table(spark, name, v1) == ["date", "temp"]
    assert T.ensure_table(spark, name, T.schema_from_fields([("date", "DATE", True), ("temp", "FLOAT", False)])) == []
    v2 = T.schema_from_fields([("date", "DATE", True), ("temp", "FLOAT64", False), ("url", "STRING", False)])
    assert T.ensure_table(spark, name, v2) == ["url"]
    with pytest.raises(T.SchemaConflict):
        T.ensure_table(spark, name, T.schema_from_fields([("temp", "STRING", False)]))
    for changed in ([("date", "DATE", False)], [("temp", "FLOAT64", True)], [("extra", "STRING", True)]):  # mode
        with pytest.raises(T.SchemaConflict):
            T.ensure_table(spark, name, T.schema_from_fields(changed))
    with pytest.raises(T.SchemaConflict):
        T.ensure_table(spark, name, v1, partition_cols=["date"])
    assert T.required_columns(spark, name) == ["date"]
    with pytest.raises(ValueError):
        T.append(spark.createDataFrame([(None, 1.0)], "date date, temp double"), name)
    with pytest.raises(ValueError):
        T.check_required(spark.createDataFrame([(None, 1.0)], "date date, temp double"), ["date"])


def test_description_last_wins(spark):
    db = f"t_{unique_suffix().replace('-', '_')}"
    T.ensure_layer(spark, db)
    T.create_or_replace_table(spark.range(3), f"{db}.g", comment="first")
    T.set_description(spark, f"{db}.g", "second")
    assert T.description(spark, f"{db}.g") == "second"


def test_description_keeps_quotes(spark):
    db = f"t_{unique_suffix().replace('-', '_')}"
    T.ensure_layer(spark, db, "it's a layer")
    T.create_or_replace_table(spark.range(3), f"{db}.g", comment="it's a 'table' \\ here")
    assert T.description(spark, f"{db}.g") == "it's a 'table' \\ here"


def test_self_read_is_found_by_path(spark):
    db = f"t_{unique_suffix().replace('-', '_')}"
    T.ensure_layer(spark, db)
    T.create_or_replace_table(spark.range(5), f"{db}.g")
    folder = spark.table(f"{db}.g").inputFiles()[0].rsplit("/", 1)[0]
    T.create_or_replace_table(spark.read.parquet(folder).filter("id > 2"), f"{db}.g")
    assert spark.table(f"{db}.g").count() == 2


def _events(spark, root, n_files=4):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    S.land_events(events, f"{root}/landing", n_files=n_files)
    return events


def test_stream_upsert_restart_is_idempotent(spark):
    root = S.run_folder(spark, "test-upsert")
    events = _events(spark, root)
    keys, rank = ["user_id", "event_type"], ["ts", "event_id"]
    args = (f"{root}/landing", f"{root}/state", f"{root}/checkpoint", keys, rank)
    S.stream_upsert(spark, *args)
    first = up.read_state(spark, f"{root}/state", S.latest_rows(keys, rank))
    n1 = first.count()
    S.stream_upsert(spark, *args)   # restart: nothing new, state unchanged
    second = up.read_state(spark, f"{root}/state", S.latest_rows(keys, rank))
    assert second.count() == n1 and first.exceptAll(second).count() == 0
    expected = events.select("user_id", "event_type").distinct().count()
    assert n1 == expected


def test_late_weeks_count_and_state_is_compacted(spark, monkeypatch):
    """Files arrive newest first: with a watermark the older ones would be dropped."""
    monkeypatch.setattr(up, "RUNS", 2)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    root = S.run_folder(spark, "test-late")
    days = [r.d for r in events.select(F.to_date("ts").alias("d")).distinct().orderBy(F.desc("d")).collect()]
    for k in range(0, len(days), 5):
        events.filter(F.to_date("ts").isin(days[k:k + 5])).coalesce(1).write.mode("append").option(
            "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{root}/landing")
        S.weekly_tumbling(spark, f"{root}/landing", f"{root}/state", f"{root}/checkpoint")
    got = {(r.week_start, r.event_type): r.n_events for r in up.read_state(spark, f"{root}/state", S.sum_weeks).collect()}
    want = events.groupBy(F.trunc("ts", "week").alias("w"), "event_type").count().collect()
    assert got == {(r.w, r.event_type): r["count"] for r in want}
    runs = up.state_runs(spark, f"{root}/state")
    assert max(level for level, _, _ in runs) >= 1 and [r[2] + 1 for r in runs[:-1]] == [r[1] for r in runs[1:]]


def test_what_a_batch_writes_does_not_grow_with_the_state(spark, monkeypatch):
    """16 batches of 50 new keys each: every row is written once per level, and a replay adds nothing."""
    monkeypatch.setattr(up, "RUNS", 2)
    path, written = scratch_path(spark, "test", f"runs-{unique_suffix()}"), []
    latest = S.latest_rows(["key"], ["batch"])

    def counted(rows):
        out = latest(rows)
        written.append(out.count())
        return out

    for b in range(16):
        batch = spark.range(50 * b, 50 * b + 50).select(F.col("id").alias("key"), F.lit(b).alias("batch"))
        up.add_batch(spark, path, batch, b, counted)
        if b in (3, 6):  # the first is part of a folded run by now, the second is not
            up.add_batch(spark, path, batch, b, latest)
    assert up.state_runs(spark, path) == [(4, 0, 15)]
    assert up.read_state(spark, path, latest).count() == 16 * 50
    assert sum(written) == 16 * 50 * 5  # levels 0 to 4
    # a fold that died: its run is not whole, and the runs that it read are there
    for b in range(16, 17):
        up.add_batch(spark, path, spark.createDataFrame([(b, b)], "key long, batch int"), b, latest)
    spark.range(1).write.parquet(f"{path}/run-1-16-17")
    up.remove_path(spark, f"{path}/run-1-16-17/_SUCCESS")
    assert [r[0] for r in up.state_runs(spark, path)] == [4, 0]


def test_a_batch_of_refused_documents_completes_and_restarts(spark):
    root = S.run_folder(spark, "test-refused")
    spark.createDataFrame([("not json",), ('{"request":{"point_id":"p"},"error":true}',)], "value string").write.text(f"{root}/landing")
    args = (f"{root}/landing", f"{root}/weather", f"{root}/ckpt", "weather", f"{root}/quarantine")
    S.stream_ingest(spark, *args)
    S.stream_ingest(spark, *args)
    assert sorted(r.reason for r in spark.read.parquet(f"{root}/quarantine").collect()) == ["NOT_JSON", "NO_DAILY_DATA"]


def test_ingest_jobs_and_stream(spark):
    from hebdo.operators import jobs
    from hebdo.sources import payloads as P
    from hebdo.sources.fixtures import fixture
    root = S.run_folder(spark, "test-ingest")
    weather = fixture(spark, "/root/testdata/sf0.001", "fx_raw_weather")
    docs = P.weather_payloads_from_raw(weather)
    n = jobs.ingest_weather_docs(spark, docs, f"{root}/weather", f"{root}/quarantine")
    assert n == weather.count()
    cols = ["date", "point_id", "temp_mean"]
    got = snapshots.read(spark, f"{root}/weather").select(*cols)
    assert got.exceptAll(weather.select(*cols)).count() == 0 and got.count() == weather.count()
    # the same payloads as a file stream into a second table: same content
    docs.write.text(f"{root}/landing")
    S.stream_ingest(spark, f"{root}/landing", f"{root}/weather2", f"{root}/ckpt", "weather", files_per_batch=1)
    again = snapshots.read(spark, f"{root}/weather2").select(*cols)
    assert again.exceptAll(got).count() == 0 and again.count() == got.count()
    flu = fixture(spark, "/root/testdata/sf0.001", "fx_raw_flu")
    nf = jobs.ingest_flu_docs(spark, P.flu_payloads_from_raw(flu), f"{root}/flu")
    assert 0 < nf <= flu.count()
    pm = fixture(spark, "/root/testdata/sf0.001", "fx_raw_pm25")
    daily = pm.groupBy("sensor_id", "date_utc").agg(*[F.max(c).alias(c) for c in
                                                      ("value", "units", "parameter", "location_id", "longitude", "latitude")])
    npm = jobs.ingest_pm25_docs(spark, P.pm25_pages_from_raw(daily), f"{root}/pm25")
    assert npm == daily.count()


def test_pages_without_rows_are_quarantined(spark):
    from hebdo.operators import jobs
    root = S.run_folder(spark, "test-no-results")
    texts = ["not json", '{"detail":"Too many requests"}', "42", "[1]", '{"results":null}', '{"results":[]}', '{"data":[]}',
             '{"data":[{"value":1}]}', None, "", "4703 words after a number"]
    pages = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "sensor_id long, value string")
    assert jobs.ingest_pm25_docs(spark, pages, f"{root}/pm25", f"{root}/quarantine") == 0
    got = [(r.reason, r.document) for r in spark.read.parquet(f"{root}/quarantine").collect()]
    assert sorted(t for reason, t in got if reason == "NO_RESULTS") == sorted(texts[1:5])
    assert {t for reason, t in got if reason == "NOT_JSON"} == {"not json", None, "", texts[-1]}
    assert [reason for reason, _ in got if reason not in ("NO_RESULTS", "NOT_JSON")] == ["NO_TIMESTAMP"]


def test_islands_hold_keys_outside_the_run_range(spark, monkeypatch):
    from hebdo.plans import q_gaps
    queries = (q_gaps.q_date_islands, q_gaps.q_week_islands)
    want = [sorted(map(str, q(spark, "/root/testdata/sf0.001").collect())) for q in queries]
    monkeypatch.setattr(q_gaps, "RUN_START", "1997-01-01")
    monkeypatch.setattr(q_gaps, "RUN_END", "1997-12-31")
    assert [sorted(map(str, q(spark, "/root/testdata/sf0.001").collect())) for q in queries] == want


def test_a_run_with_a_failed_step_fails(spark):
    from hebdo.operators import jobs
    spark.range(3).createOrReplaceTempView("three_rows")
    good = ("good", lambda: "three_rows")
    assert [r.rows for r in jobs.run_job(spark, [good, ("verify", lambda: "three_rows", True)]).collect()] == [3, 3]
    with pytest.raises(jobs.JobFailed, match="failed steps: bad, verify$") as failed:
        jobs.run_job(spark, [good, ("bad", lambda: "no_such_table"), ("later", lambda: "three_rows"),
                             ("verify", lambda: "three_rows", True)])
    assert [r.ok for r in failed.value.status.collect()] == [True, False, True, False]
