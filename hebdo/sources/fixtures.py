"""Views that stand for the raw layer, built from the driver tables.

Each view is one SQL text that Spark (UTC, ANSI) and DuckDB both run unchanged, so the same
text feeds the Spark jobs (as temp views) and the DuckDB oracle (inlined as CTEs).
Order dates are 1995-2001, hence a ``1996-01-01`` gold cutoff in the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

GOLD_CUTOFF = "1996-01-01"

# The fixture view texts (FIXTURES.md section B), in dependency order.
FIXTURE_SQL = {
    "fx_raw_pm25": """
SELECT CAST(l_suppkey AS BIGINT) AS sensor_id, l_shipdate AS date_utc,
  CASE WHEN l_linenumber = 7 OR extract(WEEK FROM l_shipdate) % 9 = 4 THEN NULL ELSE l_extendedprice / 100 - 20 END AS value,
  'ug/m3' AS units, 'pm25' AS parameter,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_suppkey % 25 END AS location_id,
  CAST(-119.5 AS DOUBLE) AS longitude, CAST(36.75 AS DOUBLE) AS latitude
FROM lineitem""",
    "fx_raw_weather": """
SELECT date, region_label, point_id, lat, lon, CASE WHEN gap THEN NULL ELSE temp_min END AS temp_min,
  CASE WHEN gap THEN NULL ELSE temp_max END AS temp_max, CASE WHEN gap THEN NULL ELSE temp_mean END AS temp_mean
FROM (SELECT CAST(o_orderdate AS DATE) AS date, concat('R', CAST(o_custkey % 3 AS STRING)) AS region_label,
    concat('p', CAST(o_custkey % 6 AS STRING)) AS point_id,
    CAST(30 + o_custkey % 6 AS DOUBLE) AS lat, CAST(-120 + o_custkey % 6 AS DOUBLE) AS lon,
    extract(WEEK FROM CAST(o_orderdate AS DATE)) % 11 = 5
      OR (extract(WEEK FROM CAST(o_orderdate AS DATE)) % 13 = 6
          AND (CAST(o_orderdate AS DATE) <> CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) OR o_custkey % 6 >= 4)) AS gap,
    min(o_totalprice) / 5000 - 20 AS temp_min, max(o_totalprice) / 5000 - 20 AS temp_max,
    CASE WHEN sum(o_orderkey) % 13 = 0 THEN NULL ELSE (max(o_totalprice) + min(o_totalprice)) / 10000 - 20 END AS temp_mean
  FROM orders GROUP BY CAST(o_orderdate AS DATE), o_custkey % 6, o_custkey % 3) t""",
    "fx_raw_flu": """
SELECT 'ca' AS region,
  CAST(extract(YEAR FROM week_start + INTERVAL 3 DAY) * 100 + extract(WEEK FROM week_start) AS BIGINT) AS epiweek,
  week_start, wili, wili / 2 AS ili, num_ili, num_patients, release_date
FROM (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
    CASE WHEN sum(o_orderkey) % 17 = 0 THEN NULL ELSE min(o_totalprice) / 5000 - 0.5 END AS wili,
    CAST(count(*) AS BIGINT) AS num_ili,
    CASE WHEN sum(o_orderkey) % 19 = 0 THEN NULL WHEN sum(o_orderkey) % 23 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(count(*) * 3 AS BIGINT) END AS num_patients,
    max(o_orderdate) AS release_date
  FROM orders GROUP BY CAST(date_trunc('week', o_orderdate) AS DATE)) t""",
    "fx_flu_regions": """
SELECT region, CAST(extract(YEAR FROM week_start + INTERVAL 3 DAY) * 100 + extract(WEEK FROM week_start) AS BIGINT) AS epiweek,
  week_start, wili, wili / 2 AS ili, num_ili, num_patients, release_date
FROM (SELECT concat('r', CAST(o_custkey % 3 AS STRING)) AS region, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
    CASE WHEN sum(o_orderkey) % 17 < 5 THEN NULL ELSE min(o_totalprice) / 5000 - 0.5 END AS wili, CAST(count(*) AS BIGINT) AS num_ili,
    CASE WHEN sum(o_orderkey) % 19 = 0 THEN NULL WHEN sum(o_orderkey) % 23 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(count(*) * 9 AS BIGINT) END AS num_patients,
    max(o_orderdate) AS release_date
  FROM orders GROUP BY o_custkey % 3, CAST(date_trunc('week', o_orderdate) AS DATE)) t""",
    "fx_flu_revisions": """
SELECT 'ca' AS region, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start, o_orderpriority AS batch,
  min(o_totalprice) / 5000 AS wili,
  CASE WHEN max(o_orderkey) % 7 = 0 THEN NULL ELSE max(o_orderdate) END AS release_date,
  max(o_orderkey) AS ingest_seq
FROM orders GROUP BY CAST(date_trunc('week', o_orderdate) AS DATE), o_orderpriority""",
    "fx_existing_days": """
SELECT DISTINCT concat('p', CAST(o_custkey % 6 AS STRING)) AS point_id, CAST(o_orderdate AS DATE) AS date
FROM orders WHERE o_orderkey % 3 <> 0""",
    "fx_existing_weeks": """
SELECT DISTINCT 'ca' AS region, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start
FROM orders WHERE extract(WEEK FROM o_orderdate) % 10 < 4""",
    "fx_points": """
SELECT DISTINCT concat('p', CAST(c_custkey % 6 AS STRING)) AS point_id FROM customer""",
    "fx_regions": """
SELECT DISTINCT 'ca' AS region FROM region""",
    "fx_upsert_target": """
SELECT date, point_id, region_label, temp_mean FROM fx_raw_weather WHERE extract(DAY FROM date) <= 20""",
    "fx_upsert_source": """
SELECT date, point_id, region_label,
  CASE WHEN extract(DAY FROM date) = 17 THEN NULL ELSE temp_mean + 1 END AS temp_mean
FROM fx_raw_weather WHERE extract(DAY FROM date) >= 15""",
}

_DEPENDS = {"fx_upsert_target": ("fx_raw_weather",), "fx_upsert_source": ("fx_raw_weather",)}


def register_driver_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    from hebdo.session import apply_engine_conf
    apply_engine_conf(spark)  # UTC dates and ANSI rules whatever session the caller built
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a DataFrame (registers the driver tables it reads)."""
    register_driver_tables(spark, sf_dir, ("orders", "lineitem", "customer", "region"))
    for dep in _DEPENDS.get(name, ()):
        spark.sql(FIXTURE_SQL[dep]).createOrReplaceTempView(dep)
    df = spark.sql(FIXTURE_SQL[name])
    df.createOrReplaceTempView(name)
    return df


def with_fixtures(body: str, *names: str) -> str:
    """Prefix an oracle query with the fixture views it uses, as CTEs (DuckDB has only the
    driver tables). ``body`` may start with its own ``WITH``; its CTEs are appended."""
    wanted: list[str] = []
    for name in names:
        for dep in (*_DEPENDS.get(name, ()), name):
            if dep not in wanted:
                wanted.append(dep)
    ctes = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in wanted]
    text = body.strip()
    if text[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + text[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + text
