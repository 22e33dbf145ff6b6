"""The order check at the edges of its blocks, one parse of a page, tasks that list landing files."""

from pyspark.sql import functions as F

from hebdo.plans import q_admin, q_stream
from hebdo.sources import payloads as P
from hebdo.sources import snapshots
from hebdo.sources import tables as T
from hebdo.streaming import ingest as S


def test_order_is_checked_across_blocks(spark, monkeypatch):
    """One file of 70,000 rows whose only fall lies between rows 65,535 and 65,536."""
    rows = spark.range(0, 70_000, 1, 1).select(
        F.when(F.col("id") < 65_536, 2).otherwise(1).cast("long").alias("sensor_id"), F.lit("2024-01-01").cast("timestamp").alias("date_utc"),
        F.lit(1.0).alias("value"), F.lit(None).cast("long").alias("location_id"))
    monkeypatch.setattr(q_admin, "raw_tables", lambda *_: (rows, None, None))
    monkeypatch.setattr(T, "clustered", lambda df, *_: df.coalesce(1))
    got = {r.sensor_id: (r.n, r.in_order) for r in q_admin.q_clustered_table(spark, "").collect()}
    assert got == {2: (65_536, True), 1: (4_464, False)}


def test_a_page_is_parsed_once_and_its_lists_are_looked_up_once(spark):
    pages = spark.createDataFrame([(1, "{}")], "sensor_id long, value string")
    plan = P.parse_pm25_documents(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("parseJson"), plan.count("$.results"), plan.count("$.data")) == (1, 1, 1)


def test_listing_tasks_do_not_grow_with_the_folders(spark, tmp_path):
    pages = spark.range(40).select(F.col("id").alias("sensor_id"), F.lit('{"results":[{"value":1,"date":"2024-01-01"}]}').alias("value"))
    q_stream.land_pages(pages, str(tmp_path / "landing"))
    tracker = spark.sparkContext.statusTracker()
    before, given = set(tracker.getJobIdsForGroup(None)), spark.conf.get(S.LISTING_TASKS)
    S.stream_ingest(spark, f"{tmp_path}/landing", f"{tmp_path}/t", f"{tmp_path}/c", "pm25", files_per_batch=100)
    ran = [tracker.getStageInfo(s) for j in set(tracker.getJobIdsForGroup(None)) - before for s in tracker.getJobInfo(j).stageIds]
    assert ran and max(s.numTasks for s in ran if s) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(S.LISTING_TASKS) == given
    assert snapshots.read(spark, f"{tmp_path}/t").count() == 40
