"""Summary questions over the layers: freshness, verification, counts, seasonal means,
correlations. All are global or low-cardinality aggregates (partial + final), so each
executor reduces its share before a single small merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.functions import flags
from hebdo.functions.calendar import days_inclusive


def freshness(df: DataFrame, key: str = "week_start_date") -> DataFrame:
    return df.agg(F.min(key).alias("earliest_week"), F.max(key).alias("latest_week"),
                  F.count(F.lit(1)).alias("total_weeks"))


def verify_output(gold: DataFrame, key: str = "week_start_date") -> DataFrame:
    """Range, row count and distinct keys of the gold table (checked on the week column,
    which is the key gold actually has)."""
    return gold.agg(F.min(key).alias("min_date"), F.max(key).alias("max_date"),
                    F.count(F.lit(1)).alias("total_rows"),
                    F.countDistinct(key).alias("unique_dates"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with ``<name>_rows`` per table: the tables are tagged, unioned (no columns but
    the tag are read) and counted by one conditional aggregate - one job, no join."""
    parts = [df.select(F.lit(name).alias("_t")) for name, df in tables.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.agg(*[F.count(F.when(F.col("_t") == name, 1)).alias(f"{name}_rows")
                       for name in tables])


def latest_date(df: DataFrame, key: str = "date") -> DataFrame:
    return df.agg(F.max(key).alias("latest_date"))


def season_means(gold: DataFrame, digits: int = 2) -> DataFrame:
    agg = gold.groupBy("season").agg(
        F.round(F.avg("illness_rate"), digits).alias("avg_illness_rate"),
        F.round(F.avg("pm25_avg"), digits).alias("avg_pm25"),
        F.round(F.avg("temp_avg_celsius"), digits).alias("avg_temp"))
    return agg.orderBy(flags.season_rank(F.col("season")))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are non-NULL; NULL when either side has zero
    variance (Spark's ``corr`` raises DIVIDE_BY_ZERO under ANSI there)."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def correlations(gold: DataFrame) -> DataFrame:
    return gold.agg(
        safe_corr(F.col("pm25_avg"), F.col("illness_rate")).alias("pm25_illness_correlation"),
        safe_corr(F.col("temp_avg_celsius"), F.col("illness_rate")).alias("temp_illness_correlation"))


def band_counts(pm25_silver: DataFrame) -> DataFrame:
    """Air-quality band of every single valid reading, counted per band."""
    return (pm25_silver.groupBy(flags.aq_band(F.col("pm25_value")).alias("air_quality_category"))
            .agg(F.count(F.lit(1)).alias("n_readings")))


def load_summary(rows: DataFrame, entity: str, chunk_cols: list[str], source: str) -> DataFrame:
    """Rows and distinct request chunks per entity plus a grand total (``entity = 'ALL'``),
    in one aggregate (``rollup`` expands each row to its entity and total group)."""
    chunk = F.struct(*chunk_cols) if len(chunk_cols) > 1 else F.col(chunk_cols[0])
    agg = rows.rollup(entity).agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.countDistinct(chunk).alias("n_chunks"))
    return agg.select(F.lit(source).alias("source"),
                      F.coalesce(F.col(entity).cast("string"), F.lit("ALL")).alias("entity"),
                      "n_rows", "n_chunks")


def missing_window_report(missing_ranges: DataFrame, entity: str) -> DataFrame:
    """Per entity: how many ranges and days are still missing, first and last missing day."""
    days = days_inclusive(F.col("range_start"), F.col("range_end"))
    return missing_ranges.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_ranges"), F.sum(days).cast("bigint").alias("n_missing_days"),
        F.min("range_start").alias("first_missing"), F.max("range_end").alias("last_missing"))
