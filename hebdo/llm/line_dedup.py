"""Deduplication of lines that several documents share.

Every line's key (white space at its ends stripped, A-Z lower-cased) is hashed to 128 bits; an aggregate
over the hashes, combined in the tasks first, tells which keys several documents hold and the first
of these. Each document's lines to drop are gathered as positions, and the text is put together again
from the other positions.

A key may be in a large part of all lines. Keys that hold more than one line in ``HEAVY_SHARE`` are
at most ``HEAVY_SHARE`` many, so they are broadcast and their lines stay where they are; no key of
the shuffled join holds more than that share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import SPACES, once, text_of, written

HEAVY_SHARE = 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(SPACES)), _UPPER, _LOWER)


# a row is named by its doc_id and its text: rows that agree in both lose the same lines. A null
# doc_id comes after all others.
_ROW = ("no_id", "id", "text_hash")


def _row_name() -> list[Column]:
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
            F.xxhash64(text_of()).alias("text_hash")]


def shared_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """(no_id, id, text_hash, dropped): the positions, from 0, of the lines that each row loses."""
    lines = docs.select(*_row_name(), F.posexplode(lines_of(text_of())).alias("pos", "line"))
    lines = lines.select(*_ROW, "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    lines = written(lines.select(*_ROW, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")),
                    "line-hashes")
    doc = F.struct("no_id", "id")
    if min_docs <= 2:  # two documents: the smallest and the largest differ
        held = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(doc).alias("first"), F.max(doc).alias("last"))
        shared = held.filter("first != last").drop("last") if min_docs == 2 else held.drop("last")
    else:
        held = (lines.groupBy("h1", "h2", "no_id", "id").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"), F.min(doc).alias("first")))
        shared = held.filter(F.col("docs") >= min_docs).drop("docs")
    shared = written(shared, "shared-lines")
    many = lines.count() / HEAVY_SHARE
    heavy = shared.filter(F.col("n") > many).select("h1", "h2", "first", F.lit(True).alias("heavy"))
    found = lines.join(F.broadcast(heavy), ["h1", "h2"], "left")
    rest = (found.filter("heavy IS NULL").drop("first", "heavy")
            .join(shared.filter(F.col("n") <= many).drop("n"), ["h1", "h2"]))
    kept_in = (F.col("no_id") == F.col("first.no_id")) & (F.col("id") == F.col("first.id"))
    lost = [part.filter(~kept_in).select(*_ROW, "pos") for part in (found.filter("heavy"), rest)]
    return reduce(DataFrame.union, lost).groupBy(*_ROW).agg(F.collect_set("pos").alias("dropped"))


def drop_shared_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """One row per document: ``row`` (all its columns), n_lines, n_dropped and ``kept``, the text without
    the lines that it loses.

    A text is split at line feeds; null and empty texts are one empty line. Keys of at least
    ``min_chars`` code points that at least ``min_docs`` documents hold lose all their lines, except in
    the document with the smallest doc_id. Rows with the same doc_id count as one document, as do all
    rows without one, which come last. The other lines stay as they are, with their line
    feeds. An empty table gives no rows; a text that loses all its lines becomes empty.
    """
    lost = shared_lines(docs, min_chars, min_docs)
    named = docs.select(F.struct("*").alias("row"), *_row_name())
    joined = (named.join(lost, list(_ROW), "left")
              .select("row", "dropped", once(lines=lines_of(text_of("row.text")))))
    keep = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(keep, lambda k: F.get(F.col("lines"), k)), "\n")
    return joined.select("row", F.size("lines").cast("long").alias("n_lines"),
                         F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                         F.when(F.col("dropped").isNull(), text_of("row.text"))
                         .otherwise(kept).alias("kept"))
