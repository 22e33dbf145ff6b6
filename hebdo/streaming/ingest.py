"""Structured Streaming forms of the ingest: new landing files are processed once
(``Trigger.AvailableNow``), with checkpoints in the shared checkpoint folder so a restarted
or retried query resumes where it stopped.

- :func:`land_events`      write driver events as JSON landing files (the stream's input)
- :func:`weekly_tumbling`  Monday-aligned 7-day windows; late events count
- :func:`stream_upsert`    the latest row per key over all micro-batches
- :func:`stream_dedup`     natural keys, each once
- :func:`stream_dedup_bounded`  the same with state for a window only
- :func:`stream_ingest`    landing payload files through the batch ingest jobs

The three event streams keep their state as what each micro-batch adds (reduced by key, a run per
batch, folded level by level; see ``operators.upsert``). So what a batch writes does not grow with
the state but for the number of levels, a replay replaces it, and no row is late: nothing is dropped by
a watermark, and the state is bounded by the number of keys, not by the number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampType)

from hebdo.operators.upsert import add_batch, latest_by, remove_path
from hebdo.session import forget_on_exit, scratch_path, unique_suffix
from hebdo.sources.payloads import with_source
from hebdo.sources.snapshots import insert_new

EVENT_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType()),
])

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's landing files, checkpoints and outputs; it goes when the driver
    ends."""
    return forget_on_exit(spark, scratch_path(spark, "streams", f"{name}-{unique_suffix()}"))


def land_events(events: DataFrame, landing: str, n_files: int | None = None) -> str:
    """Write events as JSON files, split by day so that later files hold later events; by
    default as many files as AQE finds right for the data. Event time is written as an instant
    (timestamp, not timestamp_ntz)."""
    out = events.withColumn("ts", F.col("ts").cast("timestamp"))
    ranged = out.repartitionByRange(n_files, "ts") if n_files else out.repartitionByRange("ts")
    ranged.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(landing)
    return landing


def event_stream(spark: SparkSession, landing: str, files_per_batch: int = 2) -> DataFrame:
    return (spark.readStream.schema(EVENT_SCHEMA)
            .option("maxFilesPerTrigger", files_per_batch)
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
            .json(landing))


def weekly_window(ts_col: str = "ts"):
    # The epoch (1970-01-01) is a Thursday; a 4-day offset makes windows start on Mondays.
    return F.window(F.col(ts_col), "7 days", startTime="4 days")


def _fold(stream: DataFrame, state: str, checkpoint: str, reduce_rows) -> str:
    """Run the stream to the end of the available files; each micro-batch adds to ``state``."""
    def add(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch.sparkSession, state, batch, batch_id, reduce_rows)

    q = (stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return state


def sum_weeks(rows: DataFrame) -> DataFrame:
    return rows.groupBy("week_start", "event_type").agg(
        F.sum("n_events").alias("n_events"), F.sum("total_value").alias("total_value"))


def weekly_tumbling(spark: SparkSession, landing: str, state: str, checkpoint: str) -> str:
    """Events per Monday week and type, added up over micro-batches: a late event adds to its
    week whenever it comes. Read with ``read_state(spark, state, sum_weeks)``."""
    weeks = event_stream(spark, landing).select(
        weekly_window().getField("start").cast("date").alias("week_start"), "event_type",
        F.lit(1).cast("long").alias("n_events"), F.col("value").alias("total_value"))
    return _fold(weeks, state, checkpoint, sum_weeks)


def stream_upsert(spark: SparkSession, landing: str, state: str, checkpoint: str,
                  keys: list[str], rank_cols: list[str]) -> str:
    """Keep the latest row per key (by ``rank_cols``) across all micro-batches: a newer row is
    never replaced by an older one arriving later."""
    return _fold(event_stream(spark, landing), state, checkpoint, latest_rows(keys, rank_cols))


def latest_rows(keys: list[str], rank_cols: list[str]):
    return lambda rows: latest_by(rows, keys, [F.col(c) for c in rank_cols])


def stream_dedup(spark: SparkSession, landing: str, state: str, checkpoint: str, keys: list[str]) -> str:
    """Each natural key once, however often and however late it repeats in the stream."""
    s = event_stream(spark, landing).withColumn("day", F.to_date("ts"))
    return _fold(s.select(*keys), state, checkpoint, DataFrame.distinct)


def stream_dedup_bounded(spark: SparkSession, landing: str, target_path: str, checkpoint: str, keys: list[str],
                         window: str = "1 hour") -> str:
    """Each natural key once, like ``stream_dedup``, with state for one window only.

    Keys that repeat within ``window`` of their arrival are dropped by the stream's own state, which forgets
    them after it. The window runs over the time of arrival (the batch's), not over event time, so
    no row is late and none is dropped for it. What comes through is inserted into the versioned table at
    ``target_path`` if the key isn't there: of the stored files only those whose range and bitmap
    allow a key of the batch are read, and only new rows are written. A replay finds its keys there."""
    s = (event_stream(spark, landing).withColumn("day", F.to_date("ts")).withColumn("arrived", F.current_timestamp())
         .withWatermark("arrived", window).dropDuplicatesWithinWatermark(keys).select(*keys))

    def add(batch: DataFrame, _batch_id: int) -> None:
        # written once: each action on the batch would run the stream's plan again, with its state. The insert reads
        # the files in the caller's session; the stream's own one has no adaptive plans
        path = scratch_path(spark, "staging", f"dedup-{unique_suffix()}")
        batch.write.parquet(path)
        try:
            insert_new(spark, target_path, spark.read.schema(batch.schema).parquet(path), keys, "day" if "day" in keys else None)
        finally:
            remove_path(spark, path)

    q = (s.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return target_path


def stream_ingest(spark: SparkSession, landing: str, target_path: str, checkpoint: str,
                  kind: str, quarantine_path: str | None = None, files_per_batch: int = 8) -> str:
    """Incremental ingest of landing payload files (STR1 + STR2): every micro-batch of new
    files runs the batch ingest job (parse, quarantine, latest record per key, merge by file into
    the versioned table at ``target_path``; read it with ``sources.snapshots.read``). The merge is
    keyed and the quarantine is per batch id, so a replayed batch leaves the same rows; a page that
    comes twice merges once; a batch whose rows are all refused merges nothing. PM2.5 pages lie
    in ``sensor_id=<id>`` folders, which name the sensor."""
    from hebdo.operators import jobs

    run = {"weather": jobs.ingest_weather_docs, "flu": jobs.ingest_flu_docs, "pm25": jobs.ingest_pm25_docs}[kind]
    # the stream lists its folders and files several times: in as many tasks as keep the cores busy, not one for each path
    given = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(given), 4 * spark.sparkContext.defaultParallelism)))
    try:
        return _ingest(spark, run, landing, target_path, checkpoint, kind, quarantine_path, files_per_batch)
    finally:
        spark.conf.set(LISTING_TASKS, given)


def _ingest(spark: SparkSession, run, landing: str, target_path: str, checkpoint: str, kind: str, quarantine_path: str | None,
            files_per_batch: int) -> str:
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if kind == "pm25":
        reader = reader.schema("value string, sensor_id bigint")
    docs = with_source(reader.text(landing))  # so that a replay ranks the documents alike

    def each(batch: DataFrame, batch_id: int) -> None:
        run(batch.sparkSession, batch, target_path, quarantine_path, batch_id)

    q = (docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return target_path
