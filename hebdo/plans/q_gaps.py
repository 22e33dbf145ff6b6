"""Registered gap-planning queries: missing keys, islands, chunks, backfill plan, range join.

Run range parameters (the reference's START/END job arguments): the driver data spans
1995-01-01 .. 2001-11-04, so the run asks for 1995-01-01 .. 2001-12-31.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hebdo.functions import calendar as cal
from hebdo.operators import gaps
from hebdo.plans.registry import query
from hebdo.session import apply_engine_conf
from hebdo.sources.fixtures import fixture, with_fixtures

RUN_START, RUN_END = "1995-01-01", "2001-12-31"
CHUNK_WEEKS = 26       # default request size of the weekly source
SMALL_CHUNK_WEEKS = 4  # second size used by week_chunks, so that islands are split


def _days(spark, sf_dir):
    """Loaded (point, day) keys of the run range."""
    apply_engine_conf(spark)
    return gaps.existing_keys(fixture(spark, sf_dir, "fx_existing_days"), "date", RUN_START, RUN_END, "point_id")


def _weeks(spark, sf_dir):
    """Loaded (region, week) keys of the run range."""
    apply_engine_conf(spark)
    return gaps.existing_keys(fixture(spark, sf_dir, "fx_existing_weeks"), "week_start",
                              cal.monday(RUN_START), RUN_END, "region")


def _run_range(entities):
    return entities.select("*", F.lit(RUN_START).cast("date").alias("start"), F.lit(RUN_END).cast("date").alias("end"))


def _point_ranges(spark, sf_dir):
    """The control dimension of points, with the run range."""
    return _run_range(fixture(spark, sf_dir, "fx_points"))


def _region_ranges(spark, sf_dir):
    return _run_range(fixture(spark, sf_dir, "fx_regions"))


# ---- oracle pieces (islands by start/end detection, independent of the row_number trick)
def _islands_sql(src: str, part: list[str], key: str, step: int, out: str) -> str:
    on = " AND ".join(f"b.{p} = a.{p}" for p in part)
    pl = ", ".join(part)
    sel_s = ", ".join(f"s.{p}" for p in part)
    join = " AND ".join(f"e.{p} = s.{p}" for p in part)
    return f"""{out}_s AS (SELECT {pl}, {key} AS range_start FROM {src} a
    WHERE NOT EXISTS (SELECT 1 FROM {src} b WHERE {on} AND b.{key} = a.{key} - {step})),
  {out}_e AS (SELECT {pl}, {key} AS range_end FROM {src} a
    WHERE NOT EXISTS (SELECT 1 FROM {src} b WHERE {on} AND b.{key} = a.{key} + {step})),
  {out} AS (SELECT {sel_s}, s.range_start, min(e.range_end) AS range_end
    FROM {out}_s s JOIN {out}_e e ON {join} AND e.range_end >= s.range_start
    GROUP BY {sel_s}, s.range_start)"""


DAY_MISSING = f"""pts AS (SELECT point_id FROM fx_points),
  spine AS (SELECT point_id, CAST(unnest(generate_series(DATE '{RUN_START}', DATE '{RUN_END}', INTERVAL 1 DAY)) AS DATE) AS date FROM pts),
  missing AS (SELECT s.point_id, s.date FROM spine s
    WHERE NOT EXISTS (SELECT 1 FROM fx_existing_days x WHERE x.point_id = s.point_id AND x.date = s.date
                      AND x.date BETWEEN DATE '{RUN_START}' AND DATE '{RUN_END}'))"""


@query("missing_dates", with_fixtures(f"WITH {DAY_MISSING} SELECT point_id, date FROM missing",
                                     "fx_existing_days", "fx_points"))
def q_missing_dates(spark, sf_dir):
    apply_engine_conf(spark)
    fixture(spark, sf_dir, "fx_existing_days")
    # loaded keys of the run range, read through SQL with bound parameters
    loaded = gaps.existing_keys_sql_range(spark, "fx_existing_days", ["point_id"], "date",
                                          RUN_START, RUN_END)
    spine = gaps.day_spine(_point_ranges(spark, sf_dir), ["point_id"])
    return gaps.missing_keys(spine, loaded, ["point_id", "date"])


@query("date_islands", with_fixtures(
    "WITH " + _islands_sql("fx_existing_days", ["point_id"], "date", 1, "isl")
    + " SELECT point_id, range_start, range_end, CAST(range_end - range_start + 1 AS BIGINT) AS n_keys FROM isl",
    "fx_existing_days", "fx_points"))
def q_date_islands(spark, sf_dir):
    """Contiguous runs of loaded days per point."""
    apply_engine_conf(spark)
    loaded = fixture(spark, sf_dir, "fx_existing_days").select("point_id", "date").distinct()
    return gaps.islands(loaded, ["point_id"], "date", 1)


_WIN_SPINE = f"""pts AS (SELECT point_id FROM fx_points),
  mon AS (SELECT point_id, CAST(unnest(generate_series(DATE '{RUN_START[:8]}01', DATE '{RUN_END}', INTERVAL 1 MONTH)) AS DATE) AS m FROM pts),
  win AS (SELECT point_id, greatest(m, DATE '{RUN_START}') AS window_start,
            least(CAST(last_day(m) AS DATE), DATE '{RUN_END}') AS window_end FROM mon),
  wspine AS (SELECT point_id, window_start, window_end,
               CAST(unnest(generate_series(window_start, window_end, INTERVAL 1 DAY)) AS DATE) AS date FROM win),
  wmissing AS (SELECT * FROM wspine s WHERE NOT EXISTS
    (SELECT 1 FROM fx_existing_days x WHERE x.point_id = s.point_id AND x.date = s.date))"""


@query("missing_date_ranges", with_fixtures(
    f"WITH {_WIN_SPINE}, "
    + _islands_sql("wmissing", ["point_id", "window_start", "window_end"], "date", 1, "isl")
    + " SELECT *, CAST(range_end - range_start + 1 AS BIGINT) AS n_days FROM isl", "fx_existing_days", "fx_points"))
def q_missing_date_ranges(spark, sf_dir):
    existing = _days(spark, sf_dir)
    return gaps.missing_date_ranges(_point_ranges(spark, sf_dir), existing, ["point_id"])


@query("week_islands", with_fixtures(
    "WITH " + _islands_sql("fx_existing_weeks", ["region"], "week_start", 7, "isl")
    + " SELECT region, range_start, range_end, CAST((range_end - range_start) // 7 + 1 AS BIGINT) AS n_keys FROM isl",
    "fx_existing_weeks", "fx_regions"))
def q_week_islands(spark, sf_dir):
    """Contiguous runs of loaded ISO weeks per region (consecutive across year ends)."""
    apply_engine_conf(spark)
    loaded = fixture(spark, sf_dir, "fx_existing_weeks").select("region", "week_start").distinct()
    return gaps.islands(loaded, ["region"], "week_start", 7)


WEEK_MISSING = f"""regs AS (SELECT region FROM fx_regions),
  wspine AS (SELECT region, CAST(unnest(generate_series(CAST(date_trunc('week', DATE '{RUN_START}') AS DATE),
              CAST(date_trunc('week', DATE '{RUN_END}') AS DATE), INTERVAL 7 DAY)) AS DATE) AS week_start FROM regs),
  wmissing AS (SELECT * FROM wspine s WHERE NOT EXISTS
    (SELECT 1 FROM fx_existing_weeks x WHERE x.region = s.region AND x.week_start = s.week_start))"""


def _chunks_sql(src: str, n: int) -> str:
    return f"""chunks AS (
  SELECT region, range_start, range_end, chunk_start,
    least(chunk_start + 7 * ({n} - 1), range_end) AS chunk_end
  FROM (SELECT region, range_start, range_end,
          range_start + 7 * {n} * CAST(unnest(generate_series(0, ((range_end - range_start) // 7) // {n})) AS INTEGER) AS chunk_start
        FROM {src}) c)"""


@query("week_chunks", with_fixtures(
    f"WITH {WEEK_MISSING}, " + _islands_sql("wmissing", ["region"], "week_start", 7, "isl")
    + ", " + _chunks_sql("isl", SMALL_CHUNK_WEEKS)
    + " SELECT region, range_start, range_end, chunk_start, chunk_end, "
      "CAST((chunk_end - chunk_start) // 7 + 1 AS BIGINT) AS chunk_weeks FROM chunks",
    "fx_existing_weeks", "fx_regions"))
def q_week_chunks(spark, sf_dir):
    """Missing-week islands split into chunks of at most 4 weeks."""
    existing = _weeks(spark, sf_dir)
    spine = gaps.week_spine(_region_ranges(spark, sf_dir), ["region"])
    isl = gaps.islands(gaps.missing_keys(spine, existing, ["region", "week_start"]),
                       ["region"], "week_start", 7)
    return gaps.chunk_weeks(isl, SMALL_CHUNK_WEEKS).select(
        "region", "range_start", "range_end", "chunk_start", "chunk_end", "chunk_weeks")


def _ew(expr: str) -> str:
    return f"CAST(isoyear({expr}) * 100 + week({expr}) AS BIGINT)"


MISSING_WEEK_CHUNKS_SQL = (
    f"WITH {WEEK_MISSING}, " + _islands_sql("wmissing", ["region"], "week_start", 7, "isl")
    + ", " + _chunks_sql("isl", CHUNK_WEEKS))


@query("missing_week_chunks", with_fixtures(
    MISSING_WEEK_CHUNKS_SQL
    + f" SELECT region, chunk_start, chunk_end, CAST((chunk_end - chunk_start) // 7 + 1 AS BIGINT) AS chunk_weeks, "
      f"{_ew('chunk_start')} AS chunk_start_epiweek, {_ew('chunk_end')} AS chunk_end_epiweek FROM chunks",
    "fx_existing_weeks", "fx_regions"))
def q_missing_week_chunks(spark, sf_dir):
    existing = _weeks(spark, sf_dir)
    return gaps.missing_week_chunks(_region_ranges(spark, sf_dir), existing, ["region"], CHUNK_WEEKS)


@query("plan_backfill", with_fixtures(
    f"WITH {_WIN_SPINE}, " + _islands_sql("wmissing", ["point_id", "window_start", "window_end"], "date", 1, "disl")
    + f", {WEEK_MISSING.replace('wspine', 'kspine').replace('wmissing', 'kmissing')}, "
    + _islands_sql("kmissing", ["region"], "week_start", 7, "isl") + ", " + _chunks_sql("isl", CHUNK_WEEKS)
    + """ SELECT 'daily' AS source, point_id AS entity, range_start AS request_start, range_end AS request_end FROM disl
      UNION ALL SELECT 'weekly', region, chunk_start, chunk_end FROM chunks""",
    "fx_existing_days", "fx_points", "fx_existing_weeks", "fx_regions"))
def q_plan_backfill(spark, sf_dir):
    days, weeks = _days(spark, sf_dir), _weeks(spark, sf_dir)
    return gaps.plan_backfill(_point_ranges(spark, sf_dir), days, "point_id",
                              _region_ranges(spark, sf_dir), weeks, "region", CHUNK_WEEKS)


@query("chunk_range_join", with_fixtures(
    MISSING_WEEK_CHUNKS_SQL + f""" SELECT f.region, f.epiweek, f.week_start, c.chunk_start, c.chunk_end
    FROM fx_raw_flu f JOIN chunks c ON f.region = c.region
      AND {_ew('f.week_start')} BETWEEN {_ew('c.chunk_start')} AND {_ew('c.chunk_end')}""",
    "fx_existing_weeks", "fx_regions", "fx_raw_flu"))
def q_chunk_range_join(spark, sf_dir):
    """Each flu row with the request chunk (same region) whose epiweek range holds it."""
    existing = _weeks(spark, sf_dir)
    chunks = gaps.missing_week_chunks(_region_ranges(spark, sf_dir), existing, ["region"], CHUNK_WEEKS)
    flu = fixture(spark, sf_dir, "fx_raw_flu").select("region", "epiweek", "week_start")
    return gaps.chunk_membership(flu, chunks.select("region", "chunk_start", "chunk_end"),
                                 "region", "week_start")


# Ranges of unlike lengths: every run of loaded days of a point, each point's calendar months, and the
# time between a point's first and last order of each priority.
_RANGES = """ranges AS (
    SELECT 'island' AS kind, point_id, range_start, range_end FROM isl
    UNION ALL SELECT 'priority', 'p' || CAST(o_custkey % 6 AS VARCHAR), CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)
      FROM orders GROUP BY 2, o_orderpriority
    UNION ALL SELECT 'month', point_id, date_trunc('month', date)::DATE, last_day(date)::DATE FROM fx_existing_days GROUP BY ALL)"""


@query("interval_join", with_fixtures(
    "WITH " + _islands_sql("fx_existing_days", ["point_id"], "date", 1, "isl") + ", " + _RANGES + """
SELECT kind, r.point_id, range_start, range_end, count(*) AS n_days, min(w.date) AS first_day, max(w.date) AS last_day,
  count(w.temp_mean) AS n_means
FROM fx_raw_weather w JOIN ranges r ON w.point_id = r.point_id AND w.date BETWEEN r.range_start AND r.range_end GROUP BY ALL""",
    "fx_existing_days", "fx_raw_weather"))
def q_interval_join(spark, sf_dir):
    """Daily weather rows with all ranges of their point that hold them, from one day to seven years long."""
    apply_engine_conf(spark)
    loaded = fixture(spark, sf_dir, "fx_existing_days")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    kind = lambda df, name: df.select(F.lit(name).alias("kind"), "point_id", "range_start", "range_end")
    ranges = kind(gaps.islands(loaded, ["point_id"], "date", 1), "island").unionByName(kind(
        orders.groupBy(F.concat(F.lit("p"), (F.col("o_custkey") % 6).cast("string")).alias("point_id"), "o_orderpriority")
        .agg(F.min("o_orderdate").cast("date").alias("range_start"), F.max("o_orderdate").cast("date").alias("range_end")), "priority"))
    ranges = ranges.unionByName(kind(loaded.select("point_id", F.trunc("date", "month").alias("range_start"),
                                                   F.last_day("date").alias("range_end")).distinct(), "month"))
    days = fixture(spark, sf_dir, "fx_raw_weather").select("point_id", "date", "temp_mean")
    joined = gaps.interval_join(days, ranges, "point_id", "date", "range_start", "range_end")
    return joined.groupBy("kind", "point_id", "range_start", "range_end").agg(
        F.count(F.lit(1)).alias("n_days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.count("temp_mean").alias("n_means"))


@query("missing_sensor_weeks", with_fixtures(f"""WITH run AS (SELECT s_suppkey AS sensor_id,
    unnest(generate_series(DATE '1995-01-02', DATE '{RUN_END}', INTERVAL 7 DAY))::DATE AS week_start FROM supplier),
  loaded AS (SELECT DISTINCT sensor_id, date_trunc('week', date_utc)::DATE AS week_start FROM fx_raw_pm25)
SELECT run.sensor_id::BIGINT AS sensor_id, count(*) AS n_missing, min(run.week_start) AS first_missing, max(run.week_start) AS last_missing
FROM run ANTI JOIN loaded ON run.sensor_id = loaded.sensor_id AND run.week_start = loaded.week_start GROUP BY 1""", "fx_raw_pm25"))
def q_missing_sensor_weeks(spark, sf_dir):
    """Weeks without a reading of the sensors asked for: the control table's, every supplier. The loaded
    keys are looked up for this set of entities only."""
    apply_engine_conf(spark)
    asked = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").cast("bigint").alias("sensor_id"))
    days = gaps.existing_keys_of(fixture(spark, sf_dir, "fx_raw_pm25"), "date_utc", "1995-01-02", "2002-01-06", "sensor_id", asked)
    loaded = days.select("sensor_id", cal.monday(F.to_date("date_utc")).alias("week_start")).distinct()
    spine = gaps.week_spine(asked.select("sensor_id", F.lit("1995-01-02").cast("date").alias("start"),
                                         F.lit(RUN_END).cast("date").alias("end")), ["sensor_id"])
    return gaps.missing_keys(spine, loaded, ["sensor_id", "week_start"]).groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n_missing"), F.min("week_start").alias("first_missing"), F.max("week_start").alias("last_missing"))
