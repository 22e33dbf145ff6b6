"""Gap planning: which keys of a calendar are not loaded yet, as contiguous ranges/chunks.

The reference walks calendars in Python per entity; here every step is a set-based job:
entity ranges -> spine (``explode(sequence)`` on the executors) -> anti-join with the loaded
keys -> gaps-and-islands -> chunks. Spines are bounded by the calendar (days or weeks of the
requested range), not by the data, and the island window is partitioned by entity (and by
month window for days), so no task holds more than one entity's calendar slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hebdo.functions import calendar as cal


def existing_keys(df: DataFrame, key: str, start, end, entity_col: str | None = None,
                  entity=None, distinct: bool = True) -> DataFrame:
    """Loaded keys of one entity (or all) within [start, end] (pushed down to the scan)."""
    cond = F.col(key).between(cal.as_col(start), cal.as_col(end))
    if entity_col is not None and entity is not None:
        cond = cond & (F.col(entity_col) == F.lit(entity))
    cols = [entity_col, key] if entity_col else [key]
    out = df.filter(cond).select(*cols)
    return out.distinct() if distinct else out


def existing_keys_sql_range(spark: SparkSession, table: str, entity_cols: list[str], key: str,
                            start, end) -> DataFrame:
    """Loaded (entity..., key) of every entity within [start, end], with bound parameters."""
    cols = ", ".join([*entity_cols, key])
    return spark.sql(f"SELECT DISTINCT {cols} FROM {table} WHERE {key} BETWEEN :start AND :end",
                     args={"start": start, "end": end})


#: Entity sets up to this size become an IN list of the scan.
MAX_ENTITIES = 1024


def existing_keys_of(df: DataFrame, key: str, start, end, entity_col: str, entities: DataFrame) -> DataFrame:
    """Loaded (entity, key) within [start, end] of the entities asked for (a column ``entity_col``), distinct.

    A set of at most ``MAX_ENTITIES`` entities is put into the scan's filter, so files and row groups that
    hold none of them are skipped; of a larger one the smallest and largest are, and a semi join
    does the rest. Nothing more than that many values reaches the driver."""
    asked = entities.select(entity_col).filter(F.col(entity_col).isNotNull()).distinct()
    some = [r[0] for r in asked.limit(MAX_ENTITIES + 1).collect()]
    loaded = df.filter(F.col(key).between(cal.as_col(start), cal.as_col(end)))
    if len(some) <= MAX_ENTITIES:
        return loaded.filter(F.col(entity_col).isin(some)).select(entity_col, key).distinct()
    ends = asked.agg(F.min(entity_col).alias("low"), F.max(entity_col).alias("high")).first()
    within = loaded.filter(F.col(entity_col).between(F.lit(ends["low"]), F.lit(ends["high"])))
    return within.select(entity_col, key).join(asked, entity_col, "left_semi").distinct()


def spread_entities(ranges: DataFrame, entity_cols: list[str]) -> DataFrame:
    """Hash-partition a (small) entity table over the cluster's cores before a generator.

    AQE sizes partitions by their *input* bytes, so a small entity table can be coalesced
    into one partition, and one task would then generate every entity's calendar (millions of
    sensors x thousands of days). An explicit partition count is kept by AQE."""
    spark = ranges.sparkSession
    try:
        n = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext on the client
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(n, *entity_cols)


def day_spine(ranges: DataFrame, entity_cols: list[str], start: str = "start",
              end: str = "end", key: str = "date") -> DataFrame:
    """(entity..., date) for every day of each entity's [start, end]."""
    return spread_entities(ranges, entity_cols).select(
        *entity_cols, F.explode(cal.day_spine(F.col(start), F.col(end))).alias(key))


def week_spine(ranges: DataFrame, entity_cols: list[str], start: str = "start",
               end: str = "end", key: str = "week_start") -> DataFrame:
    """(entity..., Monday) for every ISO week touching each entity's [start, end]."""
    return spread_entities(ranges, entity_cols).select(
        *entity_cols, F.explode(cal.week_spine(F.col(start), F.col(end))).alias(key))


def month_windows(ranges: DataFrame, entity_cols: list[str], start: str = "start",
                  end: str = "end") -> DataFrame:
    """Calendar months of [start, end], the first starting at start, the last ending at end."""
    m = spread_entities(ranges, entity_cols).select(
                      *entity_cols, F.col(start).alias("_s"), F.col(end).alias("_e"),
                      F.explode(cal.month_window_starts(F.col(start), F.col(end))).alias("_m"))
    ws, we = cal.clip_month_window(F.col("_m"), F.col("_s"), F.col("_e"))
    return m.select(*entity_cols, ws.alias("window_start"), we.alias("window_end"))


def missing_keys(spine: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Spine rows whose key is not loaded (set difference as a left anti join)."""
    return spine.join(existing.select(*keys), keys, "left_anti")


def islands(keys_df: DataFrame, part_cols: list[str], key: str, step_days: int = 1) -> DataFrame:
    """Maximal runs of consecutive keys (``step_days`` apart) per partition -> (start, end, n).

    Consecutive keys share ``key - step * row_number``; keys must be distinct per partition."""
    w = Window.partitionBy(*part_cols).orderBy(key)
    grp = F.date_sub(F.col(key), (F.row_number().over(w) * step_days).cast("int"))
    return (keys_df.withColumn("_island", grp)
            .groupBy(*part_cols, "_island")
            .agg(F.min(key).alias("range_start"), F.max(key).alias("range_end"),
                 F.count(F.lit(1)).alias("n_keys"))
            .drop("_island"))


def chunk_weeks(ranges: DataFrame, max_weeks: int, start: str = "range_start",
                end: str = "range_end") -> DataFrame:
    """Split each Monday range into chunks of at most ``max_weeks`` weeks; the last is short.

    A generator per range (no window, no shuffle)."""
    if max_weeks <= 0:
        raise ValueError("max_weeks must be positive")
    s, e = F.col(start), F.col(end)
    n_weeks = F.floor(F.datediff(e, s) / 7) + 1
    n_chunks = F.floor((n_weeks - 1) / max_weeks)
    idx = F.explode(F.sequence(F.lit(0), n_chunks.cast("int"))).alias("chunk_index")
    out = ranges.select("*", idx)
    cs = F.date_add(s, F.col("chunk_index") * (7 * max_weeks))
    ce = F.least(F.date_add(cs, 7 * (max_weeks - 1)), e)
    return (out.withColumn("chunk_start", cs).withColumn("chunk_end", ce)
            .withColumn("chunk_weeks", (F.datediff(F.col("chunk_end"), F.col("chunk_start")) / 7 + 1).cast("bigint")))


def missing_week_chunks(ranges: DataFrame, existing: DataFrame, entity_cols: list[str],
                        max_weeks: int = 26, key: str = "week_start") -> DataFrame:
    """Chunks (entity, chunk_start_ew, chunk_end_ew) of ISO weeks not yet loaded."""
    spine = week_spine(ranges, entity_cols, key=key)
    miss = missing_keys(spine, existing, [*entity_cols, key])
    isl = islands(miss, entity_cols, key, step_days=7)
    ch = chunk_weeks(isl, max_weeks)
    return ch.select(*entity_cols, "chunk_start", "chunk_end", "chunk_weeks",
                     cal.epiweek(F.col("chunk_start")).alias("chunk_start_epiweek"),
                     cal.epiweek(F.col("chunk_end")).alias("chunk_end_epiweek"))


def missing_date_ranges(ranges: DataFrame, existing: DataFrame, entity_cols: list[str],
                        key: str = "date") -> DataFrame:
    """Per entity and month window, the contiguous ranges of days not yet loaded.
    Ranges never cross a month end, because the search runs per window."""
    win = month_windows(ranges, entity_cols)
    spine = win.select(*entity_cols, "window_start", "window_end",
                       F.explode(cal.day_spine(F.col("window_start"), F.col("window_end"))).alias(key))
    miss = missing_keys(spine, existing, [*entity_cols, key])
    isl = islands(miss, [*entity_cols, "window_start", "window_end"], key, step_days=1)
    return isl.withColumnRenamed("n_keys", "n_days")


def plan_backfill(day_ranges: DataFrame, existing_days: DataFrame, day_entity: str,
                  week_ranges: DataFrame, existing_weeks: DataFrame, week_entity: str,
                  max_weeks: int = 26) -> DataFrame:
    """One request plan for both calendars: (source, entity, request_start, request_end)."""
    days = missing_date_ranges(day_ranges, existing_days, [day_entity]).select(
        F.lit("daily").alias("source"), F.col(day_entity).cast("string").alias("entity"),
        F.col("range_start").alias("request_start"), F.col("range_end").alias("request_end"))
    weeks = missing_week_chunks(week_ranges, existing_weeks, [week_entity], max_weeks).select(
        F.lit("weekly").alias("source"), F.col(week_entity).cast("string").alias("entity"),
        F.col("chunk_start").alias("request_start"), F.col("chunk_end").alias("request_end"))
    return days.unionByName(weeks)


def chunk_membership(rows: DataFrame, chunks: DataFrame, entity: str, key: str,
                     chunk_start: str = "chunk_start", chunk_end: str = "chunk_end") -> DataFrame:
    """Range join: each row with the week chunk of the same entity whose [start, end] holds it.

    Instead of a non-equi join (one hot entity would pair all its rows with all its chunks
    in one task), each chunk is expanded to its Mondays (at most ``max_weeks`` rows) and the
    rows join on (entity, Monday): an equi-join on a high-cardinality key."""
    weeks = chunks.select(F.col(entity).alias("_ce"), chunk_start, chunk_end,
                          F.explode(F.sequence(F.col(chunk_start), F.col(chunk_end),
                                               F.expr("INTERVAL 7 DAYS"))).alias("_wk"))
    cond = (F.col(entity) == F.col("_ce")) & (cal.monday(F.col(key)) == F.col("_wk"))
    return rows.join(weeks, cond, "inner").drop("_ce", "_wk")


def interval_join(rows: DataFrame, ranges: DataFrame, entity: str, key: str, start: str, end: str,
                  bin_days: int = 32) -> DataFrame:
    """Range join for ranges of any length: each row (entity, date ``key``) with every range of its entity whose
    days [start, end] hold it; a row without a range is left out.

    Ranges are cut at the edges of fixed bins of days, so a range has a row per bin that it touches, not
    per day; rows meet ranges in an equi-join on (entity, bin), and the exact test follows. A row lies
    in one bin, so it meets a range once. No task pairs all rows of a hot entity with all its ranges."""
    bin_of = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / bin_days)
    cut = ranges.filter(F.col(start) <= F.col(end)).select(
        F.struct("*").alias("_range"), F.col(entity).alias("_entity"),
        F.explode(F.sequence(bin_of(F.col(start)), bin_of(F.col(end)))).alias("_bin"))
    names = [c for c in ranges.columns if c != entity]
    joined = rows.join(cut, (F.col(entity) == F.col("_entity")) & (bin_of(F.col(key)) == F.col("_bin")))
    return (joined.filter(F.col(key).between(F.col(f"_range.{start}"), F.col(f"_range.{end}")))
            .select(*rows.columns, *[F.col(f"_range.{c}").alias(c) for c in names]))
