"""Registered calendar queries: epiweeks, Monday alignment, ranges, spines, month windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from hebdo.functions import calendar as cal
from hebdo.operators import gaps
from hebdo.plans.registry import query
from hebdo.session import apply_engine_conf
from hebdo.sources.fixtures import fixture, register_driver_tables, with_fixtures


def _orders(spark, sf_dir):
    apply_engine_conf(spark)
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


# ISO calendar for the oracle: every Monday 1899-12-25 .. 2101-01-03 with its ISO epiweek.
ISO_MONDAYS = """iso AS (
  SELECT CAST(m AS DATE) AS week_start, CAST(isoyear(m) * 100 + week(m) AS BIGINT) AS ew
  FROM generate_series(TIMESTAMP '1899-12-25', TIMESTAMP '2101-01-03', INTERVAL 7 DAY) t(m))"""


@query("epiweek_encode", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
  CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS BIGINT) AS epiweek
FROM orders""")
def q_epiweek_encode(spark, sf_dir):
    o = _orders(spark, sf_dir)
    d = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", d.alias("order_date"), cal.epiweek(d).alias("epiweek"))


_CANDIDATES = """cand AS (
  SELECT DISTINCT epiweek AS candidate FROM fx_raw_flu
  UNION SELECT DISTINCT (epiweek // 100) * 100 + 53 FROM fx_raw_flu
  UNION SELECT DISTINCT (epiweek // 100) * 100 FROM fx_raw_flu)"""


@query("epiweek_decode", with_fixtures(f"""WITH {ISO_MONDAYS}, {_CANDIDATES}
SELECT c.candidate AS epiweek, iso.week_start, iso.week_start IS NOT NULL AS is_valid
FROM cand c LEFT JOIN iso ON iso.ew = c.candidate""", "fx_raw_flu"))
def q_epiweek_decode(spark, sf_dir):
    """Every epiweek of the flu table plus, per year, week 53 and week 00 probes."""
    flu = fixture(spark, sf_dir, "fx_raw_flu")
    ew = F.col("epiweek")
    year_base = (F.floor(ew / 100) * 100).cast("bigint")
    cand = flu.select(F.explode(F.array(ew, year_base + 53, year_base)).alias("epiweek")).distinct()
    return cand.select("epiweek", cal.epiweek_monday(ew).alias("week_start"),
                       cal.epiweek_is_valid(ew).alias("is_valid"))


@query("epiweek_advance", with_fixtures("""
SELECT epiweek, n AS weeks,
  CAST(isoyear(week_start + 7 * n) * 100 + week(week_start + 7 * n) AS BIGINT) AS advanced
FROM (SELECT DISTINCT epiweek, week_start FROM fx_raw_flu) f, (VALUES (1), (4), (52), (-1)) v(n)""",
                                       "fx_raw_flu"))
def q_epiweek_advance(spark, sf_dir):
    flu = fixture(spark, sf_dir, "fx_raw_flu").select("epiweek").distinct()
    steps = flu.select("epiweek", F.explode(F.array(*[F.lit(n) for n in (1, 4, 52, -1)])).alias("weeks"))
    return steps.select("epiweek", "weeks",
                        cal.epiweek_add(F.col("epiweek"), F.col("weeks")).alias("advanced"))


@query("monday_align", """
SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start FROM orders""")
def q_monday_align(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", cal.monday(F.col("o_orderdate")).alias("week_start"))


@query("resolve_range", """
SELECT o_orderkey, s AS range_start, e AS range_end,
  CASE WHEN e < s THEN 'END_BEFORE_START' ELSE 'OK' END AS status
FROM (SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS s,
        CAST(date_trunc('week', CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 5 AS INTEGER)) AS DATE) AS e
      FROM orders) t""")
def q_resolve_range(spark, sf_dir):
    """Monday-aligned request ranges stored per order: start = order date,
    end = order date + (orderkey % 40 - 5) days (some end before they start)."""
    o = _orders(spark, sf_dir)
    start = F.col("o_orderdate").cast("date")
    end = F.date_add(start, (F.col("o_orderkey") % 40 - 5).cast("int"))
    s, e, status = cal.resolve_range_cols(start, end, align_monday=True)
    return o.select("o_orderkey", s.alias("range_start"), e.alias("range_end"), status.alias("status"))


@query("week_spine", with_fixtures("""
SELECT region, CAST(unnest(generate_series(s, e, INTERVAL 7 DAY)) AS DATE) AS week_start
FROM (SELECT region, min(week_start) AS s, max(week_start) AS e FROM fx_raw_flu GROUP BY region) r""",
                                  "fx_raw_flu"))
def q_week_spine(spark, sf_dir):
    flu = fixture(spark, sf_dir, "fx_raw_flu")
    r = flu.groupBy("region").agg(F.min("week_start").alias("start"), F.max("week_start").alias("end"))
    return gaps.week_spine(r, ["region"])


@query("day_spine", with_fixtures("""
SELECT point_id, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT point_id, min(date) AS s, max(date) AS e FROM fx_raw_weather GROUP BY point_id) r""",
                                 "fx_raw_weather"))
def q_day_spine(spark, sf_dir):
    w = fixture(spark, sf_dir, "fx_raw_weather")
    r = w.groupBy("point_id").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return gaps.day_spine(r, ["point_id"])


MONTH_WINDOWS_SQL = """
SELECT point_id, greatest(m, s) AS window_start, least(CAST(last_day(m) AS DATE), e) AS window_end
FROM (SELECT point_id, s, e,
        CAST(unnest(generate_series(CAST(date_trunc('month', s) AS DATE), e, INTERVAL 1 MONTH)) AS DATE) AS m
      FROM (SELECT point_id, min(date) AS s, max(date) AS e FROM fx_raw_weather GROUP BY point_id) r) t"""


@query("month_windows", with_fixtures(MONTH_WINDOWS_SQL, "fx_raw_weather"))
def q_month_windows(spark, sf_dir):
    w = fixture(spark, sf_dir, "fx_raw_weather")
    r = w.groupBy("point_id").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return gaps.month_windows(r, ["point_id"])
