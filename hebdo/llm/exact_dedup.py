"""Exact deduplication by two passes over a Bloom filter.

Pass 1 counts every row's hash into a filter of two-bit cells (never seen, once, twice or
more). Pass 2 looks each row up: only if all its cells say "twice or more" can its hash be
repeated. Those rows alone are shuffled and grouped by the full SHA-256; the others pass
straight through, each its own group.

The filter's size is bounded by ``max_cells``: beyond it the hashes are split into several
ranges by their value, each with a filter of its own that is built, used and dropped in turn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import ship_package, squeezed, text_of, written
from hebdo.session import forget_on_exit, scratch_path, unique_suffix

#: Cells per row and cells looked at per row: about 0.24 % of unrepeated rows are shuffled.
CELLS_PER_ROW = 16
PROBES = 4
#: Cells of one filter; the part that is broadcast has one bit a cell (128 MB).
MAX_CELLS = 1 << 30
#: Cells of one piece of the filter while it is merged (16 KB a bitmap).
PIECE = 1 << 17


def cells_of(hashes: np.ndarray, n_cells: int) -> np.ndarray:
    """The cells of each hash, shape (rows, PROBES): double hashing."""
    x = hashes.view(np.uint64)
    with np.errstate(over="ignore"):
        step = (x * np.uint64(0x9E3779B97F4A7C15)) ^ (x >> np.uint64(29)) | np.uint64(1)
        mixed = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        probes = mixed[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)[None, :]
    return ((probes >> np.uint64(16)) % np.uint64(n_cells)).astype(np.int64)


def count_cells(n_cells: int):
    """mapInArrow: a partition's hashes -> its pieces of the two bitmaps (once, twice)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for batch in batches:
            held.append(np.sort(cells_of(batch.column(0).to_numpy(zero_copy_only=False), n_cells), axis=1))
            n_held += len(held[-1])
            if n_held >= 1 << 20:  # bounds the task's memory; pieces of one cell add up later
                yield from _pieces(held)
                held, n_held = [], 0
        if held:
            yield from _pieces(held)

    return run


def _pieces(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    rows = np.concatenate(held)
    new = np.ones(rows.shape, dtype=bool)  # a row counts once in a cell that two of its probes hit
    new[:, 1:] = rows[:, 1:] != rows[:, :-1]
    cells, counts = np.unique(rows[new], return_counts=True)
    piece = cells // PIECE
    starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]]) if len(cells) else np.array([], dtype=int)
    for a, b in zip(starts, np.r_[starts[1:], len(cells)], strict=True):
        once, twice = np.zeros(PIECE, dtype=bool), np.zeros(PIECE, dtype=bool)
        at = cells[a:b] % PIECE
        once[at], twice[at[counts[a:b] > 1]] = True, True
        yield pa.RecordBatch.from_pydict({"piece": pa.array([int(piece[a])], pa.int64()),
                                          "once": [np.packbits(once).tobytes()],
                                          "twice": [np.packbits(twice).tobytes()]})


def merge_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas over pieces sorted by number: one row per piece with both bitmaps."""
    row = lambda: pd.DataFrame({"piece": [number], "once": [once.tobytes()], "twice": [twice.tobytes()]})
    number, once, twice = None, None, None
    for pdf in batches:
        for n, a, b in zip(pdf["piece"], pdf["once"], pdf["twice"], strict=True):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            if n != number:
                if number is not None:
                    yield row()
                number, once, twice = n, a.copy(), b.copy()
            else:
                twice |= b | (once & a)
                once |= a
    if number is not None:
        yield row()


def filter_bits(hashes: DataFrame, n_cells: int, which: str):
    """Broadcast bitmap of the cells that ``hashes`` (one long column) hit: ``once`` or more, or
    ``twice`` or more. Its size is n_cells / 8 bytes at most, which ``max_cells`` bounds."""
    pieces = hashes.mapInArrow(count_cells(n_cells), "piece long, once binary, twice binary")
    merged = (pieces.repartition("piece").sortWithinPartitions("piece")
              .mapInPandas(merge_pieces, "piece long, once binary, twice binary").select("piece", which))
    bits = np.zeros(math.ceil(n_cells / PIECE) * (PIECE // 8), dtype=np.uint8)
    for row in merged.collect():
        at = row["piece"] * (PIECE // 8)
        bits[at:at + PIECE // 8] = np.frombuffer(row[which], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def look_up(bits, n_cells: int, column: str = "bloom_hash") -> Column:
    """Pandas UDF: may another row have this hash?"""

    @F.pandas_udf("boolean")
    def in_filter(h: pd.Series) -> pd.Series:
        at = cells_of(h.to_numpy(np.int64), n_cells)
        return pd.Series(((bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1))

    return in_filter(F.col(column))


def member_filter(members: DataFrame, column: str, max_cells: int = MAX_CELLS) -> Column:
    """A boolean over another table's ``column``: false only where ``members`` lacks the hash.
    More members than the filter has room for only make it pass more."""
    ship_package(members.sparkSession)
    n_cells = max(1024, min(max_cells, members.count() * CELLS_PER_ROW))
    return look_up(filter_bits(members.select(column), n_cells, "once"), n_cells, column)


def flag_repeated(hashed: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """``hashed`` (with a long column bloom_hash) plus bloom_repeated: false only where no
    other row has the hash. Only the hash goes through Python. With several ranges the rows are
    written twice: dealt out by range, and with their flags."""
    ship_package(hashed.sparkSession)
    n_rows = hashed.select("bloom_hash").count()
    ranges = max(1, math.ceil(n_rows * CELLS_PER_ROW / max_cells))
    n_cells = max(1024, math.ceil(n_rows * CELLS_PER_ROW / ranges))
    if ranges == 1:
        bits = filter_bits(hashed.select("bloom_hash"), n_cells, "twice")
        return hashed.withColumn("bloom_repeated", look_up(bits, n_cells))
    # each range then reads its own files alone
    hashed = written(hashed.withColumn("bloom_range", F.pmod("bloom_hash", F.lit(ranges)).cast("int")),
                     "bloom-ranges", ["bloom_range"])
    spark = hashed.sparkSession
    path = scratch_path(spark, "llm", f"bloom-flagged-{unique_suffix()}")
    for r in range(ranges):  # a range's rows are written before the next filter is built: one filter at a time
        part = hashed.filter(F.col("bloom_range") == r).drop("bloom_range")
        bits = filter_bits(part.select("bloom_hash"), n_cells, "twice")
        flagged = part.withColumn("bloom_repeated", look_up(bits, n_cells))
        flagged.write.mode("append").parquet(path)
        forget_on_exit(spark, path)
        bits.destroy()
    return spark.read.schema(flagged.schema).parquet(path)


def text_sha256(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the text without its white space, in UTF-8."""
    return F.sha2(squeezed(text).cast("binary"), 256)


# of equal texts the longest stays, then the smallest doc_id (null last)
def _order(*more: Column) -> Column:
    return F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"),
                    F.col("doc_id").alias("c"), *more)


def exact_groups(docs: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; all texts without any word are equal to each other. A null
    doc_id loses against any other. Of rows that agree in doc_id too, exactly one is kept. An
    empty table gives no rows; other columns are not read.
    """
    prints = written(docs.select("doc_id", text_sha256(text_of()).alias("text_sha256"),
                                 F.length(text_of()).alias("n_chars"),
                                 F.monotonically_increasing_id().alias("uid")), "exact-prints")
    flagged = flag_repeated(prints.withColumn("bloom_hash", F.xxhash64("text_sha256")), max_cells)
    alone = (flagged.filter(~F.col("bloom_repeated"))
             .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                     F.lit(True).alias("kept"), "text_sha256"))
    maybe = flagged.filter("bloom_repeated")
    best = written(maybe.groupBy("text_sha256")
                   .agg(F.count(F.lit(1)).alias("group_size"), F.min(_order(F.col("uid"))).alias("best")),
                   "exact-groups")
    grouped = (maybe.join(best, "text_sha256")  # a hot group's rows: AQE splits its side
               .select("doc_id", F.col("best.c").alias("keep_id"), "group_size",
                       (F.col("uid") == F.col("best.uid")).alias("kept"), "text_sha256"))
    return alone.unionByName(grouped)


def drop_exact_copies(docs: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """``docs`` with one row for each distinct text, chosen as in ``exact_groups`` (of rows with
    equal doc_id and text, any one). Rows that the filter clears are never shuffled; the copies
    of the rest are combined before the shuffle, so a large group moves one row per task."""
    hashed = docs.select(F.struct("*").alias("row"), "doc_id", F.length(text_of()).alias("n_chars"),
                         text_sha256(text_of()).alias("text_sha256"))
    flagged = flag_repeated(hashed.withColumn("bloom_hash", F.xxhash64("text_sha256")), max_cells)
    alone = flagged.filter(~F.col("bloom_repeated")).select("row")
    stays = (flagged.filter("bloom_repeated").groupBy("text_sha256")
             .agg(F.min_by("row", _order()).alias("row")).select("row"))
    return alone.unionByName(stays).select("row.*")
