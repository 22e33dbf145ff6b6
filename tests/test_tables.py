"""Rebuilds behind a name, clustering, entity-bound look-ups and range joins."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from hebdo import session
from hebdo.operators import gaps
from hebdo.session import unique_suffix
from hebdo.sources import tables as T


@pytest.fixture
def db(spark):
    name = f"t_{unique_suffix().replace('-', '_')}"
    T.ensure_layer(spark, name)
    return name


def _ids(spark, name):
    return sorted(r.id for r in spark.table(name).collect())


def test_a_rebuild_that_dies_leaves_the_old_rows(spark, db, monkeypatch):
    T.create_or_replace_table(spark.range(3), f"{db}.g", comment="kept")
    before = T.current_version(spark, f"{db}.g")
    with pytest.raises(Exception, match="boom"):  # dies while it writes
        T.create_or_replace_table(spark.range(9).select((F.when(F.col("id") < 5, F.col("id"))
                                                         .otherwise(F.raise_error(F.lit("boom")))).cast("long").alias("id")), f"{db}.g")
    write = DataFrameWriter.saveAsTable

    def die(self, *args, **kw):  # dies with its rows written
        write(self, *args, **kw)
        raise KeyboardInterrupt

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", die)
    with pytest.raises(KeyboardInterrupt):
        T.create_or_replace_table(spark.range(7), f"{db}.g")
    assert _ids(spark, f"{db}.g") == [0, 1, 2] and T.current_version(spark, f"{db}.g") == before
    monkeypatch.undo()
    T.create_or_replace_table(spark.range(4), f"{db}.g")
    assert _ids(spark, f"{db}.g") == [0, 1, 2, 3] and T.description(spark, f"{db}.g") == "kept"


def test_readers_of_the_version_before_are_served(spark, db):
    T.create_or_replace_table(spark.range(3), f"{db}.g")
    reader = spark.table(f"{db}.g")
    T.create_or_replace_table(spark.table(f"{db}.g").filter("id > 0").withColumn("more", F.lit(1)), f"{db}.g")
    assert sorted(r.id for r in reader.collect()) == [0, 1, 2]
    assert spark.table(f"{db}.g").columns == ["id", "more"] and _ids(spark, f"{db}.g") == [1, 2]
    for _ in range(3):
        T.create_or_replace_table(spark.range(5), f"{db}.g", partition_cols=None)
    assert len(T._version_tables(spark, f"{db}.g")) == 2


def test_a_table_from_elsewhere_becomes_a_version(spark, db):
    spark.range(3).write.saveAsTable(f"{db}.g")
    T.create_or_replace_table(spark.table(f"{db}.g").filter("id < 2"), f"{db}.g", comment="new")
    assert _ids(spark, f"{db}.g") == [0, 1] and T.description(spark, f"{db}.g") == "new"


def test_clustered_tables(spark, db):
    fields = [("sensor", "INT64", True), ("day", "DATE", True), ("value", "FLOAT64", False)]
    schema, name = T.schema_from_fields(fields), f"{db}.c"
    T.ensure_table(spark, name, schema, cluster_cols=["sensor", "day"])
    assert T.ensure_table(spark, name, schema, cluster_cols=["sensor", "day"]) == [] == T.ensure_table(spark, name, schema)
    for other in (["day"], []):
        with pytest.raises(T.SchemaConflict, match="clustered by"):
            T.ensure_table(spark, name, schema, cluster_cols=other)
    with pytest.raises(T.SchemaConflict, match="to cluster by"):
        T.ensure_table(spark, f"{db}.d", schema, cluster_cols=["nothing"])
    rows = spark.range(20_000).select((F.hash("id") % 500).cast("long").alias("sensor"),
                                      F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("day"),
                                      F.rand(1).alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    try:
        T.append(rows, name)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = []
    for f in spark.table(name).inputFiles():
        meta = pq.ParquetFile(f.replace("file://", "").replace("file:", "")).metadata
        spans += [(s.min, s.max) for g in range(meta.num_row_groups) for s in [meta.row_group(g).column(0).statistics]]
    spans.sort()
    assert len(spans) >= 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))  # a sensor is in one file or two
    assert "PushedFilters: [IsNotNull(sensor), EqualTo(sensor,7)]" in spark.table(name).filter("sensor = 7")._jdf.queryExecution().toString()
    with pytest.raises(T.SchemaConflict, match="no columns"):
        T.append(rows.withColumn("extra", F.lit(1)), name)
    assert spark.table(name).count() == 20_000


def test_no_silent_local_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_keys_of_the_entities_asked_for(spark, tmp_path, monkeypatch):
    loaded = spark.range(4000).select((F.col("id") % 40).alias("sensor"),
                                      F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("day"))
    loaded.write.parquet(str(tmp_path / "keys"))
    table = spark.read.parquet(str(tmp_path / "keys"))
    asked = spark.createDataFrame([(3,), (5,), (5,), (99,), (None,)], "sensor long")
    want = {(r.sensor, r.day) for r in loaded.collect() if r.sensor in (3, 5) and r.day <= dt.date(2024, 1, 3)}
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    few = gaps.existing_keys_of(table, "day", "2024-01-01", "2024-01-03", "sensor", asked)
    assert "In(sensor, [3,5,99])" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(gaps, "MAX_ENTITIES", 2)
    many = gaps.existing_keys_of(table, "day", "2024-01-01", "2024-01-03", "sensor", asked)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(sensor,3)" in plan and "LessThanOrEqual(sensor,99)" in plan and "LeftSemi" in plan
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in many.collect()} == want
    assert gaps.existing_keys_of(table, "day", "2024-01-01", "2024-01-03", "sensor", asked.limit(0)).count() == 0


@pytest.mark.parametrize("bin_days", [1, 7, 400])
def test_interval_join_against_nested_loops(spark, bin_days):
    rng = random.Random(bin_days)
    day = lambda k: dt.date(1969, 12, 1) + dt.timedelta(days=k)
    rows = [(rng.choice("ab"), day(rng.randint(0, 200)), k) for k in range(150)] + [("a", None, 900), (None, day(3), 901)]
    ranges = []
    for k in range(40):
        a, n = rng.randint(0, 200), rng.choice([0, 1, 5, 150, -3])
        ranges.append((rng.choice("abc"), day(a), day(a + n), k))
    ranges.append(("a", None, day(5), 41))
    got = gaps.interval_join(spark.createDataFrame(rows, "e string, d date, x int"),
                             spark.createDataFrame(ranges, "e string, s date, t date, r int"), "e", "d", "s", "t", bin_days)
    assert got.columns == ["e", "d", "x", "s", "t", "r"]
    want = sorted((x, r) for e, d, x in rows for f, s, t, r in ranges if e == f and d and s and s <= d <= t)
    assert sorted((r.x, r.r) for r in got.collect()) == want
