"""Registered table-management queries: schema evolution, CTAS rebuilds, the job runner."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hebdo.operators import analytics, gold, silver
from hebdo.operators.jobs import JobFailed, run_job
from hebdo.plans.parity import on_grid
from hebdo.plans.q_layers import GOLD_CTES, GOLD_SUMS, _oracle, raw_tables
from hebdo.plans.registry import query
from hebdo.session import forget_on_exit, scratch_path, unique_suffix
from hebdo.sources import tables as T
from hebdo.sources.fixtures import GOLD_CUTOFF, fixture, with_fixtures

WEATHER_V1 = [("date", "DATE", True), ("region_label", "STRING", True), ("point_id", "STRING", True),
              ("lat", "FLOAT64", True), ("lon", "FLOAT64", True), ("temp_min", "FLOAT64", False),
              ("temp_max", "FLOAT64", False), ("temp_mean", "FLOAT64", False)]
WEATHER_V2 = WEATHER_V1 + [("source_url", "STRING", False), ("chunk_start", "DATE", False)]

ROWS_PER_TASK = 500_000
BLOCK_ROWS = 65_536


def in_file_order(rows, key, tasks):
    """``rows`` (with ``file`` and ``at``, the row's place in it) plus ``in_order``: false for a row that is smaller by ``key``
    than the one before it in its file. Files are looked at in blocks, so that no task sorts a whole file;
    the last row of a block also goes before the first of the next one, where it is only compared with."""
    block = F.floor(F.col("at") / BLOCK_ROWS)
    last = F.col("at") % BLOCK_ROWS == BLOCK_ROWS - 1
    place = lambda b, edge: F.struct(b.alias("block"), F.lit(edge).alias("edge"))
    placed = F.when(last, F.array(place(block, False), place(block + 1, True))).otherwise(F.array(place(block, False)))
    rows = rows.select("*", F.inline(placed)).repartition(tasks, "file", "block")
    before = F.lag(key).over(Window.partitionBy("file", "block").orderBy("at"))
    return rows.withColumn("in_order", F.coalesce(before <= key, F.lit(True))).filter(~F.col("edge"))


def _layer(spark, name):
    db = f"{name}_{unique_suffix().replace('-', '_')}"
    # a layer of this run only: below the shared scratch folder, gone when the driver ends
    T.ensure_layer(spark, db, f"{name} layer", forget_on_exit(spark, scratch_path(spark, "layers", f"{db}.db")))
    return db


@query("ensure_table_evolution", with_fixtures("""
SELECT date, region_label, point_id, lat, lon, temp_min, temp_max, temp_mean,
  CASE WHEN extract(DAY FROM date) > 20 THEN 'landing' END AS source_url,
  CASE WHEN extract(DAY FROM date) > 20 THEN CAST(date_trunc('month', date) AS DATE) END AS chunk_start
FROM fx_raw_weather""", "fx_raw_weather"))
def q_ensure_table_evolution(spark, sf_dir):
    """Create the raw weather table, load part of it, add two columns, load the rest."""
    _, we, _ = raw_tables(spark, sf_dir)
    db = _layer(spark, "raw")
    name = f"{db}.weather"
    T.ensure_table(spark, name, T.schema_from_fields(WEATHER_V1), comment="raw daily weather")
    first = we.filter(F.dayofmonth("date") <= 20)
    T.append(first, name)
    added = T.ensure_table(spark, name, T.schema_from_fields(WEATHER_V2))
    assert added == ["source_url", "chunk_start"], added
    rest = we.filter(F.dayofmonth("date") > 20).withColumn("source_url", F.lit("landing")) \
        .withColumn("chunk_start", F.trunc("date", "month"))
    T.append(rest, name)
    return spark.table(name)


@query("ctas_rebuild", _oracle(GOLD_CTES, "SELECT * FROM features", GOLD_SUMS))
def q_ctas_rebuild(spark, sf_dir):
    """Silver and gold written as tables, then gold rebuilt from itself (a new version behind the same name)."""
    pm, we, fl = raw_tables(spark, sf_dir)
    sdb, gdb = _layer(spark, "silver"), _layer(spark, "gold")
    T.create_or_replace_table(silver.silver_pm25(pm), f"{sdb}.pm25")
    T.create_or_replace_table(silver.silver_weather(we), f"{sdb}.weather")
    T.create_or_replace_table(silver.silver_flu(fl), f"{sdb}.flu")
    g = gold.build_gold(spark.table(f"{sdb}.flu"), spark.table(f"{sdb}.pm25"),
                        spark.table(f"{sdb}.weather"), cutoff=GOLD_CUTOFF)
    T.create_or_replace_table(g, f"{gdb}.features", comment="weekly features (first)")
    T.create_or_replace_table(spark.table(f"{gdb}.features"), f"{gdb}.features",
                              comment="weekly features")
    return on_grid(spark.table(f"{gdb}.features").drop("processed_at"), GOLD_SUMS)


@query("clustered_table", with_fixtures("""
SELECT sensor_id, date_utc, location_id, count(*) AS n, min(value) AS low, max(value) AS high, true AS in_order
FROM fx_raw_pm25 GROUP BY sensor_id, date_utc, location_id""", "fx_raw_pm25"))
def q_clustered_table(spark, sf_dir):
    """Raw PM2.5 appended to a table that is clustered by sensor and location, in two loads; every file
    holds its rows in that order."""
    pm, _, _ = raw_tables(spark, sf_dir)
    name = f"{_layer(spark, 'raw')}.pm25"
    fields = [("sensor_id", "INT64", True), ("date_utc", "TIMESTAMP", True), ("value", "FLOAT64", False), ("location_id", "INT64", False)]
    layout = {"cluster_cols": ["sensor_id", "location_id"]}
    T.ensure_table(spark, name, T.schema_from_fields(fields), **layout)
    for load in (F.dayofmonth("date_utc") <= 20, F.dayofmonth("date_utc") > 20):
        T.append(pm.filter(load).select(*[f[0] for f in fields]), name)
    assert T.ensure_table(spark, name, T.schema_from_fields(fields), **layout) == []
    rows = spark.table(name).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    # as many tasks as the rows need, so that what one of them sorts does not grow with the table
    tasks = max(spark.sparkContext.defaultParallelism, -(-spark.table(name).count() // ROWS_PER_TASK))
    checked = in_file_order(rows, F.struct("sensor_id", F.col("location_id").isNotNull(), "location_id"), tasks)
    checked = checked.withColumn("date_utc", F.col("date_utc").cast("timestamp_ntz")).repartition(tasks, "sensor_id", "date_utc", "location_id")
    return (checked.groupBy("sensor_id", "date_utc", "location_id")
            .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.min("in_order").alias("in_order")))


@query("job_status", _oracle(GOLD_CTES, """
SELECT 'build' AS run, 'silver_pm25' AS step, true AS ok, (SELECT count(*) FROM pm25_good) AS rows, true AS run_ok
UNION ALL SELECT 'build', 'silver_weather', true, (SELECT count(*) FROM weather_good), true
UNION ALL SELECT 'build', 'silver_flu', true, (SELECT count(*) FROM flu_good), true
UNION ALL SELECT 'build', 'gold', true, (SELECT count(*) FROM features), true
UNION ALL SELECT 'build', 'verify', true, 1, true
UNION ALL SELECT 'copy', 'fails', false, NULL, false
UNION ALL SELECT 'copy', 'after_failure', true, (SELECT count(*) FROM pm25_good), false
UNION ALL SELECT 'copy', 'verify_after_failure', false, NULL, false"""))
def q_job_status(spark, sf_dir):
    """Silver x3 -> gold -> verification as one job, then a job with a step that fails, one that still
    runs and a verification that is skipped; returns (run, step, ok, rows, run_ok)."""
    pm, we, fl = raw_tables(spark, sf_dir)
    sdb, gdb = _layer(spark, "silver"), _layer(spark, "gold")

    def write(df, name):
        def run():
            T.create_or_replace_table(df(), name)
            return name
        return run

    verify = write(lambda: analytics.verify_output(spark.table(f"{gdb}.features")), f"{gdb}.verification")
    build = [
        ("silver_pm25", write(lambda: silver.silver_pm25(pm), f"{sdb}.pm25")),
        ("silver_weather", write(lambda: silver.silver_weather(we), f"{sdb}.weather")),
        ("silver_flu", write(lambda: silver.silver_flu(fl), f"{sdb}.flu")),
        ("gold", write(lambda: gold.build_gold(spark.table(f"{sdb}.flu"), spark.table(f"{sdb}.pm25"),
                                               spark.table(f"{sdb}.weather"), cutoff=GOLD_CUTOFF),
                       f"{gdb}.features")),
        ("verify", verify, True),
    ]
    copy = [
        ("fails", write(lambda: spark.table(f"{gdb}.no_such_table"), f"{gdb}.nothing")),
        ("after_failure", write(lambda: spark.table(f"{sdb}.pm25"), f"{gdb}.pm25_copy")),
        ("verify_after_failure", verify, True),
    ]

    def status(name, steps):
        try:
            return run_job(spark, steps).select(F.lit(name).alias("run"), "step", "ok", "rows", F.lit(True).alias("run_ok"))
        except JobFailed as failed:
            return failed.status.select(F.lit(name).alias("run"), "step", "ok", "rows", F.lit(False).alias("run_ok"))

    return status("build", build).unionByName(status("copy", copy))
