"""Registered control-string parsers, run over every document's whole text."""

from __future__ import annotations

from pyspark.sql import functions as F

from hebdo.functions.text import first_nonblank
from hebdo.operators.partitioning import spread
from hebdo.plans.registry import query
from hebdo.session import apply_engine_conf
from hebdo.sources import dims


def _docs(spark, sf_dir):
    apply_engine_conf(spark)
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


@query("sensor_ids_from_text", r"""
WITH toks AS (
  SELECT doc_id, TRY_CAST(t.tok AS BIGINT) AS sensor_id, t.i
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b\d+\b')) AS tok,
               unnest(range(1, len(regexp_extract_all(text, '\b\d+\b')) + 1)) AS i FROM documents) t),
first_seen AS (SELECT doc_id, sensor_id, min(i) AS i FROM toks WHERE sensor_id IS NOT NULL GROUP BY 1, 2)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS position, sensor_id
FROM first_seen""")
def q_sensor_ids_from_text(spark, sf_dir):
    return dims.sensor_ids(_docs(spark, sf_dir), "text", ["doc_id"])


_DEFAULTS = " UNION ALL ".join(
    f"SELECT {i} AS idx, {lat} AS lat, {lon} AS lon, '{pid}' AS point_id"
    for i, (lat, lon, pid) in enumerate(dims.DEFAULT_POINTS))

POINTS_SQL = f"""
WITH ch AS (
  SELECT doc_id, c.chunk, c.k - 1 AS idx FROM (
    SELECT doc_id, unnest(cs) AS chunk, unnest(range(1, len(cs) + 1)) AS k
    FROM (SELECT doc_id, list_filter(list_transform(string_split(COALESCE(text, ''), ';'), lambda x: trim(x)),
                                     lambda x: length(x) > 0) AS cs FROM documents) d) c),
parts AS (SELECT doc_id, idx, list_transform(string_split(chunk, ','), lambda x: trim(x)) AS p FROM ch),
parsed AS (
  SELECT doc_id, CAST(idx AS BIGINT) AS idx,
    CASE WHEN len(p) >= 2 THEN TRY_CAST(p[1] AS DOUBLE) END AS lat,
    CASE WHEN len(p) >= 2 THEN TRY_CAST(p[2] AS DOUBLE) END AS lon,
    COALESCE(CASE WHEN len(p) >= 3 THEN NULLIF(p[3], '') END,
             (['sj', 'sac', 'sd', 'la', 'sf', 'fresno'])[idx + 1], 'p' || CAST(idx + 1 AS VARCHAR)) AS point_id,
    COALESCE(CASE WHEN len(p) >= 4 THEN NULLIF(p[4], '') END, 'CA') AS region_label
  FROM parts),
valid AS (SELECT * FROM parsed WHERE lat IS NOT NULL AND lon IS NOT NULL),
defaults AS (SELECT d.doc_id, CAST(x.idx AS BIGINT) AS idx, CAST(x.lat AS DOUBLE) AS lat, CAST(x.lon AS DOUBLE) AS lon,
               x.point_id, 'CA' AS region_label
             FROM documents d, ({_DEFAULTS}) x
             WHERE d.doc_id NOT IN (SELECT doc_id FROM valid))
SELECT * FROM valid UNION ALL SELECT * FROM defaults"""


@query("points_from_text", POINTS_SQL)
def q_points_from_text(spark, sf_dir):
    return dims.points(_docs(spark, sf_dir), "text", ["doc_id"])


@query("regions_from_text", """
WITH r AS (SELECT doc_id, list_filter(list_transform(string_split(COALESCE(text, ''), ','), lambda x: lower(trim(x))),
                                     lambda x: length(x) > 0) AS rs FROM documents),
r2 AS (SELECT doc_id, CASE WHEN len(rs) > 0 THEN rs ELSE ['ca', 'state:ca'] END AS rs FROM r)
SELECT doc_id, CAST(unnest(range(1, len(rs) + 1)) AS BIGINT) AS position, unnest(rs) AS region FROM r2""")
def q_regions_from_text(spark, sf_dir):
    return dims.regions(_docs(spark, sf_dir), "text", ["doc_id"])


@query("first_nonblank", """
SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 3 = 0 THEN '  ' ELSE source END), ''),
                        nullif(trim(CASE WHEN doc_id % 2 = 0 THEN NULL ELSE lang END), ''), nullif(trim(text), '')) AS label
FROM documents""")
def q_first_nonblank(spark, sf_dir):
    """The first setting that is not blank, for each document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    source = F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.col("source"))
    lang = F.when(F.col("doc_id") % 2 == 0, F.lit(None)).otherwise(F.col("lang"))
    return docs.select("doc_id", first_nonblank(source, lang, F.col("text")).alias("label"))
