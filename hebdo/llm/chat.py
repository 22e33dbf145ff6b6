"""Chat formatting: logged conversations that are snapshots of longer ones are left out.

A service that logs a conversation after each turn writes it again and again, each time with
more turns. Every turn gets a rolling hash of the conversation up to and including it. A
conversation whose whole hash is that of a proper prefix of another is a snapshot: an anti-join
against the distinct prefix hashes leaves the maximal ones, of equal ones the smallest conv_id.
These are rendered with role markers.

The rolling hash is the XOR of one hash per turn that includes its position, so it is summed up
in two levels, within blocks of ``BLOCK`` turns and over blocks: no task needs a whole
conversation. Rendering emits a conversation in parts of ``BLOCK`` turns for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hebdo.llm.common import written

BLOCK = 256
START, END = "<|im_start|>", "<|im_end|>"
SEED = 7


def _xor(column: str, over) -> Column:
    return F.coalesce(F.bit_xor(column).over(over), F.lit(0))


def rolling(turns: DataFrame) -> DataFrame:
    """conv, conv_id, role, text, pos (from 1), n_turns, p1 and p2 (128 bits of rolling hash).

    Turns are ordered by turn, then role, then text, nulls last; equal rows are turns of their
    own. Turns without a conv_id are one conversation. Null role and text differ from empty.
    """
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n"))
    rows = turns.select(key.alias("conv"), "conv_id", "turn", "role", "text",
                        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(1 << 62)).cast("long").alias("block"))
    within = W.partitionBy("conv", "block").orderBy(*[F.col(c).asc_nulls_last() for c in ("turn", "role", "text")])
    rows = rows.withColumn("rank", F.row_number().over(within))
    before = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("conv")
    sizes = (rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
             .select("conv", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                     F.sum("n").over(whole).alias("n_turns")))
    parts = [F.col("pos"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    placed = written(rows.join(sizes, ["conv", "block"])
                     .withColumn("pos", (F.col("offset") + F.col("rank")).cast("long"))
                     .withColumn("h1", F.xxhash64(*parts)).withColumn("h2", F.xxhash64(F.lit(SEED), *parts))
                     .select("conv", "conv_id", "block", "role", "text", "pos", "n_turns", "h1", "h2"), "chat-turns")
    starts = (placed.groupBy("conv", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
              .select("conv", "block", _xor("b1", before).alias("s1"), _xor("b2", before).alias("s2")))
    so_far = W.partitionBy("conv", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (placed.select("*", _xor("h1", so_far).alias("i1"), _xor("h2", so_far).alias("i2"))
            .join(starts, ["conv", "block"])
            .select("conv", "conv_id", "role", "text", "pos", "n_turns",
                    F.col("i1").bitwiseXOR(F.col("s1")).alias("p1"), F.col("i2").bitwiseXOR(F.col("s2")).alias("p2")))


def segment(role: Column, text: Column) -> Column:
    """One rendered turn. Marker beginnings inside role and text are broken up, so that no text
    can open or close a turn."""
    plain = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(START), plain(role), F.lit("\n"), plain(text), F.lit(END + "\n"))


def collapse(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, conv_id, n_turns, copy_of, kept) and the rolled turns. ``copy_of`` is
    the smallest conv_id with the same turns."""
    rolled = written(rolling(turns), "chat-rolled")
    last = F.col("pos") == F.col("n_turns")
    convs = rolled.filter(last).select("conv", "conv_id", "n_turns", "p1", "p2")
    # both sides hold each key once: a first turn that a third of all rows share is one row here
    different = convs.groupBy("n_turns", "p1", "p2").agg(F.min("conv_id").alias("copy_of"), F.min("conv").alias("any"))
    prefixes = rolled.filter(~last).select(F.col("pos").alias("n_turns"), "p1", "p2").distinct()
    maximal = different.join(prefixes, ["n_turns", "p1", "p2"], "left_anti").select(
        "n_turns", "p1", "p2", F.lit(True).alias("maximal"))
    judged = written(different.join(maximal, ["n_turns", "p1", "p2"], "left"), "chat-different")
    same_id = F.col("conv_id").eqNullSafe(F.col("copy_of"))
    return (convs.join(judged, ["n_turns", "p1", "p2"])
            .select("conv", "conv_id", "n_turns", "copy_of",
                    (F.coalesce("maximal", F.lit(False)) & same_id).alias("kept")), rolled)


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, copy_of, kept, part, chat: a row per part of each kept conversation
    (one part up to 256 turns, then one more for each further 256), and a row without part and
    chat for each conversation left out.

    An empty table gives none; other columns are not read.
    """
    convs, rolled = collapse(turns)
    convs = written(convs, "chat-conversations")
    kept = convs.filter("kept").select(F.col("conv").alias("of"), "copy_of")
    segments = rolled.join(kept, F.col("conv") == F.col("of")).select(
        "conv_id", "n_turns", "copy_of", F.floor((F.col("pos") - 1) / BLOCK).cast("long").alias("part"),
        F.struct("pos", segment(F.col("role"), F.col("text")).alias("segment")).alias("turn"))
    chats = segments.groupBy("conv_id", "n_turns", "copy_of", "part").agg(
        F.array_join(F.sort_array(F.collect_list("turn")).getField("segment"), "").alias("chat"))
    out = ["conv_id", "n_turns", "copy_of", "kept", "part", "chat"]
    dropped = convs.filter("NOT kept").withColumn("part", F.lit(None).cast("long")).withColumn(
        "chat", F.lit(None).cast("string"))
    return chats.withColumn("kept", F.lit(True)).select(*out).unionByName(dropped.select(*out))
