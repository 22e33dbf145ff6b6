"""Keyed upserts ("MERGE by natural key") and latest-record dedup.

Semantics kept from the warehouse MERGE: a matched target row takes every updated column
from the source, *also NULLs* (never ``coalesce(source, target)``); unmatched source rows are
inserted; source rows with a NULL key are skipped; two source rows for one key are an error.

Plan: the source is reduced by key once (an aggregate that also fails on a second row of a
key) and meets the target in one full outer join on the natural key, so it is evaluated once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.session import forget_on_exit, scratch_path, unique_suffix


class DuplicateSourceKeys(ValueError):
    pass


def latest_by(df: DataFrame, keys: list[str], rank: list[Column]) -> DataFrame:
    """One row per key: the row with the greatest ``rank`` tuple (compared left to right).

    Runs as an aggregate ``max(struct(rank..., row...))`` so duplicates are reduced map-side
    before the shuffle (a key holding a third of the rows does not land whole in one task),
    and ties are broken deterministically by the row itself."""
    payload = [c for c in df.columns if c not in keys]
    rank_fields = [r.alias(f"_r{i}") for i, r in enumerate(rank)]
    best = F.max(F.struct(*rank_fields, *[F.col(c) for c in payload])).alias("_best")
    agg = df.groupBy(*keys).agg(best)
    return agg.select(*keys, *[F.col("_best")[c].alias(c) for c in payload]).select(*df.columns)


def release_rank(release_date: str = "release_date", seq: str = "ingest_seq") -> list[Column]:
    """Order of the flu dedup: a NULL release date wins, then the latest release, then the
    last fetched row (what a stable ascending sort + keep-last gives)."""
    rd = F.col(release_date)
    return [rd.isNull(), rd, F.col(seq)]


def dedup_latest(df: DataFrame, keys: list[str], release_date: str = "release_date",
                 seq: str = "ingest_seq") -> DataFrame:
    return latest_by(df, keys, release_rank(release_date, seq))


def clean_merge_source(staged: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Typed merge source from a staged batch whose columns may be text:
    ``try_cast(nullif(trim(x), ''))`` per column, other columns unchanged."""
    cols = []
    for c in staged.columns:
        if c in casts:
            text = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
            cols.append(text.try_cast(casts[c]).alias(c))
        else:
            cols.append(F.col(c))
    return staged.select(*cols)


def duplicate_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    return source.groupBy(*keys).count().filter(F.col("count") > 1)


def check_unique(source: DataFrame, keys: list[str]) -> None:
    """Fail if a key has several rows (with the number of such keys and one of them)."""
    found = duplicate_keys(source, keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*keys)).alias("key")).first()
    if found["n"]:
        raise DuplicateSourceKeys(f"source has several rows for {found['n']} keys {keys}, such as {tuple(found['key'])}")


def with_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that a merge takes: every key present."""
    return source.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def one_row_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., _row): the other columns as a struct; a second row of a key fails the job when
    the row is read. Rows with a NULL key are skipped."""
    names = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    others = F.struct(*[F.col(c) for c in source.columns if c not in keys], F.lit(True).alias("_hit"))
    return (with_keys(source, keys).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"), F.first(others).alias("_row"))
            .select(*keys, F.when(F.col("_n") == 1, F.col("_row")).otherwise(
                F.raise_error(F.concat(F.lit("source has several rows for key "), names))).alias("_row")))


def merged_rows(target: DataFrame, source: DataFrame, keys: list[str],
                update_cols: list[str] | None = None, stamp: dict[str, Column] | None = None) -> DataFrame:
    """What ``upsert`` returns, and ``_action``: whether the merge 'updated', 'inserted' or 'kept' the row."""
    stamp = stamp or {}
    have = target.columns
    update = set(have if update_cols is None else update_cols) | set(stamp)
    src = source.withColumns(stamp) if stamp else source
    joined = (target.withColumn("_old", F.lit(True)).alias("t")
              .join(one_row_per_key(src, keys).alias("s"), keys, "full_outer"))
    hit = F.coalesce(F.col("s._row._hit"), F.lit(False))
    out = [F.col(k) for k in keys]
    for c in [c for c in (*have, *[n for n in stamp if n not in have]) if c not in keys]:
        old = F.col(f"t.{c}") if c in have else F.lit(None)
        new = F.col(f"s._row.{c}") if c in src.columns else F.lit(None)
        if c in have and c in src.columns:
            new = new.cast(target.schema[c].dataType)
        out.append((F.when(hit, new).otherwise(old) if c in update else old).alias(c))
    action = F.when(~hit, "kept").when(F.col("t._old"), "updated").otherwise("inserted")
    order = [c for c in (*have, *[n for n in stamp if n not in have])]
    return joined.select(*out, action.alias("_action")).select(*order, "_action")


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           update_cols: list[str] | None = None, stamp: dict[str, Column] | None = None) -> DataFrame:
    """New state of ``target`` after merging ``source`` on ``keys``.

    ``update_cols`` defaults to every non-key column of the target; ``stamp`` sets columns on
    updated and inserted rows (e.g. ``inserted_at = current_timestamp()``). A stamp column that
    the target lacks is added, NULL on the rows that the merge leaves alone."""
    return merged_rows(target, source, keys, update_cols, stamp).drop("_action")


def merge_counts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """(updated, inserted, affected) of a merge, as one aggregate over a left join of the
    source keys with the target keys."""
    src = source.select(*keys).dropna()
    tk = target.select(*keys).distinct().withColumn("_hit", F.lit(1))
    j = src.join(tk, keys, "left")
    return j.agg(F.count(F.col("_hit")).alias("updated"),
                 F.count(F.when(F.col("_hit").isNull(), 1)).alias("inserted"),
                 F.count(F.lit(1)).alias("affected"))


def stage(df: DataFrame, name: str = "batch") -> DataFrame:
    """Staging load: write a merge source once to a fresh folder under the shared checkpoint
    root and read it back, so that an expensive source (JSON parsing) is evaluated once and a
    lost executor re-reads files instead of re-parsing payloads. The folder goes when the driver
    ends."""
    spark = df.sparkSession
    path = forget_on_exit(spark, scratch_path(spark, "staging", f"{name}-{unique_suffix()}"))
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_upsert(spark: SparkSession, target_path: str, source: DataFrame, keys: list[str],
                 partition_col: str, stamp: dict[str, Column] | None = None,
                 cluster_by: list[str] | None = None) -> int:
    """Merge ``source`` into the versioned table at ``target_path`` (``sources.snapshots``), rewriting only the files
    that hold one of its keys. Returns the number of rows merged (rows with a NULL key are skipped)."""
    from hebdo.sources.snapshots import merge_into
    return merge_into(spark, target_path, source, keys, partition_col, cluster_by, stamp).affected


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str | None) -> None:
    if path:
        fs, p = file_system(spark, path)
        fs.delete(p, True)


# ---------------------------------------------------------------------------------------
# State of a stream: runs, folders that hold what a stretch of micro-batches adds, reduced. A batch writes a run
# of its own; whenever RUNS runs of one level have gathered they are folded into one of the next level. So
# a row is written once per level, which are logarithmic in the number of batches, whatever the size
# of the state; and a reader merges fewer than RUNS runs of each level.

RUNS = 8


def state_runs(spark: SparkSession, state_path: str) -> list[tuple[int, int, int]]:
    """(level, first batch, last batch) of the runs that make up the state, by batch: whole ones (Spark writes
    ``_SUCCESS`` last) that no other covers. A run that died while it folded leaves the runs it read."""
    fs, p = file_system(spark, state_path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    found = [tuple(int(x) for x in n.split("-")[1:]) for n in names
             if n.startswith("run-") and path_exists(spark, f"{state_path}/{n}/_SUCCESS")]
    out: list[tuple[int, int, int]] = []
    for level, first, last in sorted(found, key=lambda r: (r[1], -r[2], -r[0])):
        if not out or last > out[-1][2]:
            out.append((level, first, last))
    return out


def _run_path(state_path: str, run: tuple[int, int, int]) -> str:
    return f"{state_path}/run-{run[0]}-{run[1]}-{run[2]}"


def read_state(spark: SparkSession, state_path: str, reduce_rows, runs: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """The state: ``reduce_rows`` over its runs (or over some of them)."""
    runs = state_runs(spark, state_path) if runs is None else runs
    return reduce_rows(reduce(DataFrame.unionByName, [spark.read.parquet(_run_path(state_path, r)) for r in runs]))


def add_batch(spark: SparkSession, state_path: str, batch: DataFrame, batch_id: int, reduce_rows) -> None:
    """Write what a micro-batch adds, reduced, as a run of its own, and fold full levels. A replay writes the
    same run again, or nothing where it is part of a folded one already."""
    runs = state_runs(spark, state_path)
    if not any(level > 0 and first <= batch_id <= last for level, first, last in runs):
        reduce_rows(batch).write.mode("overwrite").parquet(_run_path(state_path, (0, batch_id, batch_id)))
    level = 0
    while len(full := [r for r in state_runs(spark, state_path) if r[0] == level]) >= RUNS:
        folded = full[:RUNS]  # the oldest of a level lie beside each other: later runs are of lower levels
        to = (level + 1, folded[0][1], folded[-1][2])
        read_state(spark, state_path, reduce_rows, folded).write.mode("overwrite").parquet(_run_path(state_path, to))
        for r in folded:
            remove_path(spark, _run_path(state_path, r))
        level += 1
