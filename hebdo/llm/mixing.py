"""Mixing sources to target weights.

Sizes are summed per source; each source's target is its share of the corpus by weight, never
more than ``max_repeats`` times its own size (what is above goes to the others by weight). A
document of a source with rate r = target / size is emitted floor(r) times, and once more with
probability r - floor(r), decided by a hash of its key and the seed, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hebdo.llm.common import WORD, text_of, written

DEFAULT_WEIGHTS = (5.0, 2.0, 1.0)
#: A source table of at most so many rows (about 100 bytes each) is broadcast.
BROADCAST_SOURCES = 100_000
#: Beyond it, each source's documents are dealt over so many tasks.
SALTS = 64
DEFAULT_SEED = 17


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def source_targets(docs: DataFrame, size: Column, weights=DEFAULT_WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """One row per source: mix_source, source_size, target, rate.

    Sources by code point (null last) weigh ``weights``, repeating. The targets add up to the
    whole corpus: with sources ordered by the level at which each reaches its cap, a prefix is
    capped and the rest share what remains by weight, so the level follows from prefix sums.
    The windows run over the source table, one narrow row per source, after the aggregate.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(W.orderBy(F.col("mix_source").asc_nulls_last())) - 1)
                      % len(weights) + 1).cast("int"))
    sums = (docs.select(F.col("source").alias("mix_source"), size.alias("mix_size"))
            .groupBy("mix_source").agg(F.sum("mix_size").alias("source_size"))
            .withColumn("weight", w)
            .withColumn("cap", F.lit(float(max_repeats)) * F.col("source_size")))
    by_level = W.orderBy(F.col("cap") / F.col("weight"), F.col("mix_source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    rest = by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = by_level.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = (sums
              .withColumn("level", (F.sum(F.col("source_size").cast("double")).over(everything)
                                    - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / F.sum("weight").over(rest))
              .withColumn("fits", F.col("level") <= F.col("cap") / F.col("weight")))
    # the first source in this order that stays below its cap sets the level for all after it
    level = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    return (levels.withColumn("set_level", level.getField("level"))
            .withColumn("target", F.when(F.col("set_level").isNull(), F.col("cap"))
                        .otherwise(F.least("cap", F.col("weight") * F.col("set_level"))))
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                        .otherwise(F.lit(0.0)))
            .select("mix_source", "source_size", "target", "rate"))


def coin(seed: int, doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the document's key alone: 52 bits of the MD5 of seed
    and doc_id (of the text where doc_id is null)."""
    key = F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary")))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def plan_copies(docs: DataFrame, weights=DEFAULT_WEIGHTS, max_repeats: int = 3,
                seed: int = DEFAULT_SEED) -> DataFrame:
    """Columns: row (the document's own columns as a struct, so no name can clash), size,
    source_size, target and copies (how often the mix holds the document).

    Null source: a source of its own, last. Null or empty text: size 0. A source without words
    gets target 0 and no copies. Repeated rows share one decision. An empty table gives none.
    """
    targets = written(source_targets(docs, word_count(text_of()), weights, max_repeats), "mix-sources")
    sized = docs.select(F.struct("*").alias("row"), F.col("source").alias("doc_source"),
                        word_count(text_of()).alias("size"),
                        coin(seed, F.col("doc_id"), text_of()).alias("coin"))
    same = F.col("doc_source").eqNullSafe(F.col("mix_source"))
    if targets.count() <= BROADCAST_SOURCES:
        joined = sized.join(F.broadcast(targets), same)
    else:
        salted = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = sized.withColumn("doc_salt", F.floor(F.col("coin") * SALTS * 1024) % SALTS)
        joined = dealt.join(salted, same & (F.col("doc_salt") == F.col("salt")))
    whole = F.floor("rate")
    copies = (whole + (F.col("coin") < F.col("rate") - whole).cast("long")).cast("long")
    return joined.select("row", "size", "source_size", "target", copies.alias("copies"))


def mix_sources(docs: DataFrame, weights=DEFAULT_WEIGHTS, max_repeats: int = 3,
                seed: int = DEFAULT_SEED) -> DataFrame:
    """The mixed corpus: each document's row as often as the mix takes it, ``docs``' columns."""
    return (plan_copies(docs, weights, max_repeats, seed).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
            .select("row.*"))
