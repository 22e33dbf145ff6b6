"""SparkSession factory and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

# Settings the engine relies on for results (UTC dates, ANSI errors) and for plans at scale
# (AQE re-plans joins from runtime sizes, splits skewed partitions, coalesces small ones).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from static estimates (an explode's estimate is its input's size, so a
    # spine of millions of rows can look tiny); AQE broadcasts a join side only after it has
    # *measured* the side's shuffle output below this size, else the sort-merge join stays.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app_name: str = "hebdo",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine settings.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset so the submitted
    configuration wins; tests pass ``local[*]`` and a small partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on an existing session (e.g. one the driver built)."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only in local mode, as in tests, an
    unset one falls back to a folder under the warehouse directory, which is registered; on a cluster it fails.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on the client (Spark Connect)
        sc = None
    configured = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    try:
        configured = configured or spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset runtime key
        pass
    if not configured:
        # one machine (tests): a folder beside the warehouse is shared by all there is
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        configured = warehouse.rstrip("/") + "/_hebdo_checkpoints"
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (written tables, stream state, landing files)."""
    return "/".join([checkpoint_root(spark), "hebdo", *parts])


def unique_suffix() -> str:
    return f"{os.getpid()}-{os.urandom(4).hex()}"


def forget_on_exit(spark: SparkSession, path: str) -> str:
    """Have the file system that holds ``path`` delete it when the driver ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path
