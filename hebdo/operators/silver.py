"""Raw -> silver: type, rename, flag quality, keep the valid rows.

Each builder is one projection plus one filter over a raw DataFrame; Catalyst pushes the
value predicates towards the scan and prunes the unused raw columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.functions import flags


def flag_pm25(raw: DataFrame) -> DataFrame:
    """All raw PM2.5 rows with silver columns and their quality flag (no filter)."""
    ts = F.col("date_utc")
    return raw.select(
        ts.alias("measurement_timestamp"),
        F.to_date(ts.cast("timestamp")).alias("measurement_date"),
        "location_id", "sensor_id", "latitude", "longitude",
        F.col("value").alias("pm25_value"),
        F.col("units").alias("pm25_unit"),
        "parameter",
        flags.pm25_flag(F.col("value")).alias("data_quality_flag"),
        F.current_timestamp().alias("processed_at"),
    )


def silver_pm25(raw: DataFrame) -> DataFrame:
    return flag_pm25(raw).filter(
        (F.col("data_quality_flag") == "VALID")
        & F.col("measurement_date").isNotNull()
        & F.col("pm25_value").between(0, 500))


def flag_weather(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("date").cast("date").alias("measurement_date"),
        F.col("region_label").alias("city"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.col("temp_max").alias("temp_max_celsius"),
        F.col("temp_min").alias("temp_min_celsius"),
        F.col("temp_mean").alias("temp_mean_celsius"),
        flags.weather_flag(F.col("temp_mean")).alias("data_quality_flag"),
        F.current_timestamp().alias("processed_at"),
    )


def silver_weather(raw: DataFrame) -> DataFrame:
    return flag_weather(raw).filter(
        (F.col("data_quality_flag") == "VALID") & F.col("measurement_date").isNotNull())


def flag_flu(raw: DataFrame) -> DataFrame:
    rate, patients = F.col("wili"), F.col("num_patients")
    return raw.select(
        "epiweek",
        F.col("week_start").cast("date").alias("week_start_date"),
        F.col("region").alias("geo_code"),
        F.lit("state").alias("geo_type"),
        rate.alias("flu_rate_value"),
        F.col("ili").alias("ili_rate"),
        "num_ili", "num_patients",
        flags.flu_flag(rate, patients).alias("data_quality_flag"),
        F.current_timestamp().alias("processed_at"),
        flags.flu_stderr(rate, patients).alias("flu_rate_stderr"),
    )


def silver_flu(raw: DataFrame) -> DataFrame:
    return flag_flu(raw).filter(
        F.col("data_quality_flag").isin("VALID", "LOW_SAMPLE_SIZE")
        & F.col("week_start_date").isNotNull()
        & F.col("flu_rate_value").isNotNull())


def quality_flag_counts(pm25_raw: DataFrame, weather_raw: DataFrame, flu_raw: DataFrame) -> DataFrame:
    """Rows per (source, flag) over all three raw tables, before filtering."""
    parts = [
        flag_pm25(pm25_raw).select(F.lit("pm25").alias("source"), "data_quality_flag"),
        flag_weather(weather_raw).select(F.lit("weather").alias("source"), "data_quality_flag"),
        flag_flu(flu_raw).select(F.lit("flu").alias("source"), "data_quality_flag"),
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.groupBy("source", "data_quality_flag").agg(F.count(F.lit(1)).alias("n_rows"))
