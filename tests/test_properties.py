"""Properties of the set-based operators."""

import datetime as dt

from pyspark.sql import functions as F

from hebdo.functions import calendar as cal
from hebdo.operators import gaps, silver, upsert as up
from hebdo.sources.fixtures import fixture

from conftest import SF_SMALL


def test_upsert_idempotent(spark):
    t = fixture(spark, SF_SMALL, "fx_upsert_target")
    s = fixture(spark, SF_SMALL, "fx_upsert_source")
    once = up.upsert(t, s, ["date", "point_id"])
    twice = up.upsert(once, s, ["date", "point_id"])
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_islands_partition_missing_set(spark):
    existing = fixture(spark, SF_SMALL, "fx_existing_days")
    ranges = existing.select("point_id").distinct().select(
        "point_id", F.lit("1995-01-01").cast("date").alias("start"), F.lit("1996-12-31").cast("date").alias("end"))
    spine = gaps.day_spine(ranges, ["point_id"])
    missing = gaps.missing_keys(spine, existing, ["point_id", "date"])
    isl = gaps.missing_date_ranges(ranges, existing, ["point_id"])
    covered = isl.select("point_id", F.explode(F.sequence("range_start", "range_end")).alias("date"))
    assert covered.exceptAll(missing).count() == 0 and missing.exceptAll(covered).count() == 0
    assert isl.filter(F.month("range_start") != F.month("range_end")).count() == 0


def test_chunks_bounded(spark):
    existing = fixture(spark, SF_SMALL, "fx_existing_weeks")
    ranges = existing.select("region").distinct().select(
        "region", F.lit("1995-01-01").cast("date").alias("start"), F.lit("2001-12-31").cast("date").alias("end"))
    ch = gaps.missing_week_chunks(ranges, existing, ["region"], 5)
    assert ch.filter(F.col("chunk_weeks") > 5).count() == 0


def test_epiweek_roundtrip(spark):
    mondays = spark.range(1).select(F.explode(F.sequence(F.lit(dt.date(1995, 1, 2)), F.lit(dt.date(2030, 12, 30)),
                                                         F.expr("INTERVAL 7 DAYS"))).alias("m"))
    bad = mondays.filter(cal.epiweek_monday(cal.epiweek(F.col("m"))) != F.col("m"))
    assert mondays.count() == 1879 and bad.count() == 0


def test_silver_equals_raw_minus_flagged(spark):
    raw = fixture(spark, SF_SMALL, "fx_raw_pm25")
    flagged = silver.flag_pm25(raw).filter(F.col("data_quality_flag") != "VALID").count()
    assert silver.silver_pm25(raw).count() == raw.count() - flagged
