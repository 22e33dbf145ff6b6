"""Silver -> gold: weekly aggregates, left joins on the Monday week, calendar, lag and
rolling features.

Plan notes (scale): the weekly aggregates are partial/final hash aggregates, so a week that
holds a third of all readings is combined map-side before the shuffle. Their output has one
row per calendar week (a few thousand rows for decades of data), so AQE, which measures the
shuffled size at runtime, turns the two left joins into broadcast hash joins; if a side were
ever larger than the threshold the sort-merge join stays. The windows partition by region,
after aggregation, so no task sees more than one region's weeks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions import flags
from hebdo.functions.calendar import monday

GOLD_COLUMNS = (
    "week_start_date", "epiweek", "illness_rate", "illness_rate_stderr", "illness_sample_size",
    "pm25_avg", "pm25_stddev", "pm25_min", "pm25_max", "pm25_measurements", "num_sensors",
    "air_quality_category", "temp_avg_celsius", "temp_max_celsius", "temp_min_celsius",
    "temp_stddev", "precipitation_total_mm", "precipitation_avg_mm", "num_cities",
    "weather_days", "data_completeness",
    "year", "month", "quarter", "season", "temp_range_celsius",
    "illness_rate_lag_1w", "illness_rate_lag_2w", "illness_rate_lag_4w",
    "pm25_avg_lag_1w", "temp_avg_lag_1w",
    "pm25_rolling_4w", "temp_rolling_4w", "illness_rate_rolling_4w", "processed_at",
)


def weekly_pm25(silver: DataFrame) -> DataFrame:
    v = F.col("pm25_value")
    agg = (silver.groupBy(monday(F.col("measurement_date")).alias("week_start_date"))
           .agg(F.avg(v).alias("pm25_avg"),
                F.stddev_samp(v).alias("pm25_stddev"),
                F.min(v).alias("pm25_min"),
                F.max(v).alias("pm25_max"),
                F.count(F.lit(1)).alias("num_measurements"),
                F.countDistinct("location_id").alias("num_sensors")))
    return agg.withColumn("air_quality_category", flags.aq_band(F.col("pm25_avg")))


def weekly_weather(silver: DataFrame) -> DataFrame:
    return (silver.groupBy(monday(F.col("measurement_date")).alias("week_start_date"))
            .agg(F.avg("temp_mean_celsius").alias("temp_avg_celsius"),
                 F.avg("temp_max_celsius").alias("temp_max_celsius"),
                 F.avg("temp_min_celsius").alias("temp_min_celsius"),
                 F.stddev_samp("temp_mean_celsius").alias("temp_stddev"),
                 F.lit(None).cast("double").alias("precipitation_total_mm"),
                 F.lit(None).cast("double").alias("precipitation_avg_mm"),
                 F.countDistinct("city").alias("num_cities"),
                 F.count(F.lit(1)).alias("num_days")))


def weekly_flu(silver: DataFrame) -> DataFrame:
    return (silver.filter(F.col("geo_type") == "state")
            .select("week_start_date", "epiweek", "geo_code",
                    F.col("flu_rate_value").alias("illness_rate"),
                    F.col("flu_rate_stderr").alias("illness_rate_stderr"),
                    F.col("num_patients").alias("illness_sample_size")))


def gold_joined(flu_silver: DataFrame, pm25_silver: DataFrame, weather_silver: DataFrame,
                min_days: int = 5) -> DataFrame:
    """Flu weeks left-joined with weekly PM2.5 and weather, plus the completeness flag.
    Keeps ``geo_code`` (the window partition key)."""
    f = weekly_flu(flu_silver)
    aq = weekly_pm25(pm25_silver)
    w = weekly_weather(weather_silver)
    j = f.join(aq, "week_start_date", "left").join(w, "week_start_date", "left")
    return j.select(
        "week_start_date", "epiweek", "geo_code", "illness_rate", "illness_rate_stderr",
        "illness_sample_size", "pm25_avg", "pm25_stddev", "pm25_min", "pm25_max",
        F.col("num_measurements").alias("pm25_measurements"), "num_sensors",
        "air_quality_category", "temp_avg_celsius", "temp_max_celsius", "temp_min_celsius",
        "temp_stddev", "precipitation_total_mm", "precipitation_avg_mm", "num_cities",
        F.col("num_days").alias("weather_days"),
        flags.completeness(F.col("pm25_avg"), F.col("temp_avg_celsius"), F.col("num_days"),
                           min_days).alias("data_completeness"))


def add_features(joined: DataFrame, cutoff: str = "2022-01-01", keep_geo_code: bool = False,
                 sort: bool = True) -> DataFrame:
    """Filter retained weeks, then add calendar, lag and rolling features.

    The filter runs first, so lags count retained rows, not calendar weeks (as in the source).
    """
    kept = joined.filter(F.col("data_completeness").isin("COMPLETE", "INCOMPLETE_WEEK")
                         & (F.col("week_start_date") >= F.lit(cutoff).cast("date")))
    w = Window.partitionBy("geo_code").orderBy("week_start_date")
    roll = w.rowsBetween(-3, Window.currentRow)
    d = F.col("week_start_date")
    out = kept.select(
        "*",
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.quarter(d).cast("bigint").alias("quarter"),
        flags.season(F.month(d)).alias("season"),
        (F.col("temp_max_celsius") - F.col("temp_min_celsius")).alias("temp_range_celsius"),
        F.lag("illness_rate", 1).over(w).alias("illness_rate_lag_1w"),
        F.lag("illness_rate", 2).over(w).alias("illness_rate_lag_2w"),
        F.lag("illness_rate", 4).over(w).alias("illness_rate_lag_4w"),
        F.lag("pm25_avg", 1).over(w).alias("pm25_avg_lag_1w"),
        F.lag("temp_avg_celsius", 1).over(w).alias("temp_avg_lag_1w"),
        F.avg("pm25_avg").over(roll).alias("pm25_rolling_4w"),
        F.avg("temp_avg_celsius").over(roll).alias("temp_rolling_4w"),
        F.avg("illness_rate").over(roll).alias("illness_rate_rolling_4w"),
        F.current_timestamp().alias("processed_at"),
    )
    cols = list(GOLD_COLUMNS)
    if keep_geo_code:
        cols.insert(2, "geo_code")
    out = out.select(*cols)
    return out.orderBy("week_start_date") if sort else out


def build_gold(flu_silver: DataFrame, pm25_silver: DataFrame, weather_silver: DataFrame,
               cutoff: str = "2022-01-01", min_days: int = 5, keep_geo_code: bool = False,
               sort: bool = True) -> DataFrame:
    return add_features(gold_joined(flu_silver, pm25_silver, weather_silver, min_days),
                        cutoff, keep_geo_code, sort)
