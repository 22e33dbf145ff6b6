"""Small dimensions parsed from control strings (sensor ids, points, regions).

Each parser is a column expression over any text column (a config table, or a whole
document column), run on the executors with ``split``/``regexp_extract_all``/``posexplode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.functions.text import try_number

# Default points (lat, lon, point_id), default region label, default regions.
DEFAULT_POINTS = (
    (37.34, -121.89, "sj"),
    (38.58, -121.49, "sac"),
    (32.72, -117.16, "sd"),
    (34.05, -118.24, "la"),
    (37.77, -122.42, "sf"),
    (36.74, -119.78, "fresno"),
)
DEFAULT_REGION_LABEL = "CA"
DEFAULT_REGIONS = ("ca", "state:ca")
ID_TOKEN = r"\b\d+\b"


def ids_from_text(text: Column) -> Column:
    """Distinct integer tokens in first-seen order (``007`` and ``7`` are the same id);
    tokens beyond the BIGINT range cannot be ids and are left out."""
    toks = F.transform(F.regexp_extract_all(text, F.lit(ID_TOKEN), 0), lambda t: t.try_cast("bigint"))
    return F.array_distinct(F.filter(toks, lambda x: x.isNotNull()))


def sensor_ids(df: DataFrame, text_col: str, key_cols: list[str]) -> DataFrame:
    """(keys..., position, sensor_id): one row per distinct id, position 1-based."""
    return df.select(*key_cols, F.posexplode(ids_from_text(F.col(text_col))).alias("pos", "sensor_id")) \
        .select(*key_cols, (F.col("pos") + 1).cast("bigint").alias("position"), "sensor_id")


def _default_points() -> Column:
    return F.array(*[F.struct(F.lit(float(i)).cast("bigint").alias("idx"), F.lit(lat).alias("lat"),
                              F.lit(lon).alias("lon"), F.lit(pid).alias("point_id"),
                              F.lit(DEFAULT_REGION_LABEL).alias("region_label"))
                     for i, (lat, lon, pid) in enumerate(DEFAULT_POINTS)])


def points_from_text(text: Column) -> Column:
    """Array of points from ``lat,lon[,point_id[,region_label]]`` entries separated by ``;``.

    Blank entries are ignored; entries with fewer than 2 fields or a non-numeric lat/lon are
    dropped; a missing id defaults by the entry's index (the default ids, then ``p{i+1}``); a
    missing label is ``CA``; no valid entry at all gives the six default points."""
    chunks = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda c: F.trim(c)),
                      lambda c: F.length(c) > 0)
    default_ids = F.array(*[F.lit(p[2]) for p in DEFAULT_POINTS])

    def parse(chunk: Column, idx: Column) -> Column:
        parts = F.transform(F.split(chunk, ","), lambda p: F.trim(p))
        n = F.size(parts)
        lat = F.when(n >= 2, try_number(F.try_element_at(parts, F.lit(1))))
        lon = F.when(n >= 2, try_number(F.try_element_at(parts, F.lit(2))))
        pid_given = F.when(n >= 3, F.nullif(F.try_element_at(parts, F.lit(3)), F.lit("")))
        pid_default = F.coalesce(F.try_element_at(default_ids, idx + 1),
                                 F.concat(F.lit("p"), (idx + 1).cast("string")))
        label = F.coalesce(F.when(n >= 4, F.nullif(F.try_element_at(parts, F.lit(4)), F.lit(""))),
                           F.lit(DEFAULT_REGION_LABEL))
        return F.when(lat.isNotNull() & lon.isNotNull(),
                      F.struct(idx.cast("bigint").alias("idx"), lat.alias("lat"), lon.alias("lon"),
                               F.coalesce(pid_given, pid_default).alias("point_id"),
                               label.alias("region_label")))

    parsed = F.filter(F.transform(chunks, parse), lambda p: p.isNotNull())
    return F.when(F.size(parsed) > 0, parsed).otherwise(_default_points())


def points(df: DataFrame, text_col: str, key_cols: list[str]) -> DataFrame:
    return df.select(*key_cols, F.inline(points_from_text(F.col(text_col))))


def regions_from_text(text: Column) -> Column:
    """Comma-separated region codes, trimmed and lower-cased, blanks dropped; none -> the
    default list."""
    regs = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda r: F.lower(F.trim(r))),
                    lambda r: F.length(r) > 0)
    return F.when(F.size(regs) > 0, regs).otherwise(F.array(*[F.lit(r) for r in DEFAULT_REGIONS]))


def regions(df: DataFrame, text_col: str, key_cols: list[str]) -> DataFrame:
    return df.select(*key_cols, F.posexplode(regions_from_text(F.col(text_col))).alias("pos", "region")) \
        .select(*key_cols, (F.col("pos") + 1).cast("bigint").alias("position"), "region")
