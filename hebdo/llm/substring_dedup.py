"""Removing repeated substrings: every byte under a 200-byte string that starts twice or more.

A difference cover samples positions so that any two equal strings hold sampled positions at
equal offsets; sorting the sampled positions by what follows them, and then only what they
leave open, finds all repeats without sorting every suffix. Residues modulo 3 are such a cover,
but a dense one (two thirds of all bytes). Here the cover is chosen by content: of each run of
101 consecutive 100-byte blocks, the one with the smallest hash (the last such). Any 200-byte
string holds one and equal strings hold the same, so the cover has the property that the method
needs with 2 % of the positions, and each start of a string belongs to exactly one sample.

1. Samples are sorted by name (the hash of their 100 bytes) and by the hash of their whole
   surroundings (all strings that belong to the sample); neighbours are compared. A name that
   occurs once rules its strings out; surroundings that occur again settle all its strings.
2. The open samples (3 % here, around the ends of repeats) are cut into blocks of 16 starts. A
   block whose common bytes occur once is ruled out, one whose joint bytes occur again is
   settled; of the rest every start's string is compared.
3. The settled starts are gathered per document, merged, and cut out.

Strings are compared by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.llm.common import ship_package, text_of, written
from hebdo.llm.exact_dedup import member_filter
from hebdo.llm.textbytes import BASE, BLOCK, BYTE_VALUE, INVERSE, U, mixed, powers, text_bytes

LENGTH = 200
NAME = 100  # bytes of a sample's name; a window holds LENGTH - NAME + 1 names
GRID = 16
#: A task hands on at most so many samples of one name that only differ around it; more of them
#: are open at once, and one row stands for them in the comparison of names.
FREQUENT = 8
ASK, WHOLE, OPEN, STANDS_OPEN, STANDS_WHOLE = 0, 1, 2, 3, 4
_LOW = U((1 << 21) - 1)


def groups(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """Byte ranges to work on: (begin, end, first text, last text + 1, starts before). Short texts
    go together; a long one is cut into pieces that overlap by LENGTH - 1 bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1
        if j > i:
            yield int(offsets[i]), int(offsets[j]), i, j, int(offsets[j])
            i = j
        else:
            begin, end = int(offsets[i]), int(offsets[i + 1])
            for at in range(begin, end, BLOCK):
                yield at, min(at + BLOCK + LENGTH - 1, end), i, i + 1, min(at + BLOCK, end)
            i += 1


class Prefixes:
    """Hashes of substrings of a byte range in constant time each."""

    def __init__(self, part: np.ndarray):
        self.sums = np.zeros(len(part) + 1, U)
        np.cumsum(BYTE_VALUE[part] * powers(BASE, len(part)), out=self.sums[1:])
        self.inverse = powers(INVERSE, len(part) + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.inverse[begin] + (end - begin).astype(U))


def samples(data: np.ndarray, offsets: np.ndarray):
    """Per byte range: text number, name, hash of the surroundings, first start (in the text),
    number of starts, and the sample's distance from the first start."""
    width = LENGTH - NAME + 1
    for a, b, i, j, limit in groups(offsets):
        if b - a < LENGTH:
            continue
        prefix = Prefixes(data[a:b])
        every = np.arange(b - a - NAME + 1)
        names = prefix.of(every, every + NAME)
        # smallest hash, and of equal ones the last, in each window: by doubling
        least, have = (names & ~_LOW) | (_LOW - every.astype(U)), 1
        while have * 2 <= width:
            least, have = np.minimum(least[:-have], least[have:]), have * 2
        if have < width:
            least = np.minimum(least[:have - width], least[width - have:])
        sample = (_LOW - (least & _LOW)).astype(np.int64)
        start = np.arange(len(sample))
        text = np.repeat(np.arange(i, j), np.diff(np.clip(offsets[i:j + 1], a, b)))[:len(sample)]
        fits = (start + a + LENGTH <= offsets[text + 1]) & (start + a < limit)
        start, sample, text = start[fits], sample[fits], text[fits]
        if not len(start):
            continue
        new = np.flatnonzero(np.r_[True, (sample[1:] != sample[:-1]) | (text[1:] != text[:-1])])
        first, last = start[new], start[np.r_[new[1:], len(start)] - 1]
        around = prefix.of(first, last + LENGTH) ^ mixed((last - first + 1000 * (sample[new] - first)).astype(U))
        yield text[new], names[sample[new]], around, first + a - offsets[text[new]], last - first + 1, sample[new] - first


def pack_place(first: np.ndarray, count: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """First start, number of starts (up to 101) and distance of the sample in one long."""
    return (first.astype(np.int64) << 16) | (count.astype(np.int64) << 8) | ahead.astype(np.int64)


def find_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """uid, text -> uid, name, around, place, state. Samples that a task sees twice with equal
    surroundings are settled there, and one of them stands for them."""
    for batch in batches:
        uid = batch.column(0).to_numpy(zero_copy_only=False)
        found = [x[:3] + (pack_place(*x[3:]),) for x in samples(*text_bytes(batch.column(1)))]
        if not found:
            continue
        text, name, around, place = map(np.concatenate, zip(*found, strict=True))
        order = np.lexsort((around, name))
        text, name, around, place = text[order], name[order], around[order], place[order]
        same_name = np.r_[False, name[1:] == name[:-1]]
        same = same_name & np.r_[False, around[1:] == around[:-1]]
        followed = np.r_[same[1:], False]
        state = np.where(same, WHOLE, np.where(followed, STANDS_WHOLE, ASK))
        asks = state == ASK
        run = np.cumsum(~same_name) - 1
        often = np.bincount(run, weights=asks, minlength=1)[run] > FREQUENT
        opened = asks & often
        state[opened] = OPEN
        stands = np.flatnonzero(opened)
        stands = stands[np.r_[True, run[stands][1:] != run[stands][:-1]]] if len(stands) else stands
        parts = {"uid": np.r_[uid[text], uid[text[stands]]],
                 "name": np.r_[name, name[stands]].view(np.int64),
                 "around": np.r_[around, np.zeros(len(stands), U)].view(np.int64),
                 "place": np.r_[place, place[stands]],
                 "state": np.r_[state, np.full(len(stands), STANDS_OPEN)].astype(np.int32)}
        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in parts.items()})


def compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """uid, name, around, place, state sorted by name and around -> uid, place, kind: settled,
    open, or (of each settled kind of a name that has open samples) a witness for these."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(now[0]):
            continue
        # a name's rows are decided together: what follows the last change of name is kept back
        changes = np.flatnonzero(now[1][1:] != now[1][:-1])
        if held and held[-1][1][-1] != now[1][0]:
            yield _decided(held)
            held = []
        if len(changes):
            cut = changes[-1] + 1
            yield _decided([*held, [x[:cut] for x in now]])
            held, now = [], [x[cut:] for x in now]
        held.append(now)
    if held:
        yield _decided(held)


def _decided(blocks: list[list[np.ndarray]]) -> pa.RecordBatch:
    uid, name, around, place, state = (np.concatenate(x) for x in zip(*blocks, strict=True))
    after_name = np.r_[False, name[1:] == name[:-1]]
    after = after_name & np.r_[False, around[1:] == around[:-1]]
    same_name, same = after_name | np.r_[after_name[1:], False], after | np.r_[after[1:], False]
    whole = (state == WHOLE) | (state == STANDS_WHOLE) | (state == ASK) & same
    opened = (state == OPEN) | (state == ASK) & same_name & ~same
    run = np.cumsum(~after_name) - 1
    has_open = np.bincount(run, weights=opened | (state == STANDS_OPEN))[run] > 0
    witness = whole & ~after & has_open
    kind = np.where(opened, "open", np.where(witness, "witness", "settled"))
    take = whole | opened
    return pa.RecordBatch.from_pydict({"uid": pa.array(uid[take]), "place": pa.array(place[take]),
                                       "kind": pa.array(kind[take].tolist(), pa.string())})


def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """uid, text, places, witness (lists) -> a row per block of starts of the samples: common and
    joint (hashes of the bytes that all, or any, of its strings hold), first, starts (hashes)."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        uid = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.column(2)
        text = np.repeat(np.arange(len(uid)), np.diff(lists.offsets.to_numpy()))
        place = lists.flatten().to_numpy(zero_copy_only=False)
        open_ = batch.column(3).flatten().to_numpy(zero_copy_only=False)
        count, ahead = (place >> 8) & 255, place & 255
        at = offsets[text] + (place >> 16)
        order = np.argsort(at, kind="stable")
        text, count, ahead, at, open_ = (x[order] for x in (text, count, ahead, at, open_))
        for a, b, _, _, limit in groups(offsets):
            mine = slice(*np.searchsorted(at, [a, limit]))
            if mine.start == mine.stop:
                continue
            prefix = Prefixes(data[a:b])
            low, high = (ahead - count + 1)[mine], ahead[mine]
            n = high // GRID - low // GRID + 1
            k = np.repeat(np.arange(len(n)), n)
            block = (low // GRID)[k] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
            grid = block * GRID
            near, far = np.maximum(grid, low[k]), np.minimum(grid + GRID - 1, high[k])
            sample = (at[mine] + ahead[mine] - a)[k]
            first = sample - far
            common = prefix.of(sample - grid, sample - grid - GRID + 1 + LENGTH) ^ mixed(block.astype(U))
            joint = prefix.of(first, sample - near + LENGTH) ^ mixed((near * 1000 + far).astype(U))
            size = far - near + 1
            each = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            starts = prefix.of(each, each + LENGTH).view(np.int64)
            of = text[mine][k]
            yield pa.RecordBatch.from_pydict({
                "uid": pa.array(uid[of]), "open": pa.array(open_[mine][k]),
                "first": pa.array(first + a - offsets[of]), "common": pa.array(common.view(np.int64)),
                "joint": pa.array(joint.view(np.int64)),
                "starts": pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(starts))})


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, text, places (or null) -> key, n_bytes, n_removed, spans, kept."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        n_removed, spans, kept = [], [], []
        for begin, end, places in zip(offsets[:-1], offsets[1:], batch.column(2), strict=True):
            text = data[begin:end]
            place = np.sort(places.values.to_numpy(zero_copy_only=False)) if places.is_valid else np.zeros(0, np.int64)
            first = place >> 16
            last = np.maximum.accumulate(first + ((place >> 8) & 255) - 1 + LENGTH) if len(place) else first
            new = np.flatnonzero(np.r_[True, first[1:] > last[:-1]]) if len(place) else first
            starts, ends = first[new], last[np.r_[new[1:], len(place)] - 1] if len(place) else first
            keep = np.ones(len(text) + 1, dtype=np.int8)
            if len(starts):
                step = np.zeros(len(text) + 1, dtype=np.int8)
                step[starts], step[ends] = 1, -1
                keep = 1 - np.cumsum(step, dtype=np.int8)
            kept.append(text[keep[:-1].astype(bool)].tobytes())
            n_removed.append(int((ends - starts).sum()))
            spans.append([{"begin": int(x), "end": int(y)} for x, y in zip(starts, ends, strict=True)])
        yield pa.RecordBatch.from_pydict({
            "key": batch.column(0), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(n_removed, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.binary())})


def _release(spark: SparkSession) -> None:
    """Let go of shuffle files that no plan refers to any more: Spark's cleaner removes them
    once the driver's garbage collector has seen that."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settled_starts(keyed: DataFrame) -> DataFrame:
    """uid, place of all runs of starts whose string occurs again. ``keyed``: uid, text."""
    spark = keyed.sparkSession
    found = keyed.mapInArrow(find_samples, "uid long, name long, around long, place long, state int")
    # what a task has settled needs no comparison and is spread out, so that no name is hot
    dealt = F.when(F.col("state").isin(WHOLE, OPEN), F.xxhash64("uid", "place")).otherwise(F.col("name"))
    spans = written(found.repartition(dealt).sortWithinPartitions("name", "around")
                    .mapInArrow(compare_neighbours, "uid long, place long, kind string"), "substring-spans")
    _release(spark)
    settled = spans.filter("kind != 'open'").select("uid", "place")
    lists = written(spans.filter("kind != 'settled'").groupBy("uid").agg(
        F.collect_list(F.struct("place", (F.col("kind") == "open").alias("open"))).alias("held"))
        .select("uid", F.col("held.place").alias("places"), F.col("held.open").alias("open")), "substring-open")
    some = keyed.filter(member_filter(lists, "uid")).join(lists.withColumnRenamed("uid", "uid_of"),
                                                          F.col("uid") == F.col("uid_of"))
    blocks = written(some.select("uid", "text", "places", "open").mapInArrow(
        cut_blocks, "uid long, open boolean, first long, common long, joint long, starts array<bigint>")
        .withColumn("block", F.monotonically_increasing_id()), "substring-blocks")
    _release(spark)
    # blocks whose common bytes occur again; of equal joint bytes one stands for all
    again = blocks.groupBy("common").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("common")
    joint = (blocks.groupBy("joint").agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("stands")))
    judged = written(blocks.select("block", "common", "joint", "open", "uid", "first", F.size("starts").alias("size"))
                     .join(again, "common", "left_semi").join(joint, "joint")
                     .withColumn("whole", F.col("n") > 1), "substring-judged")
    by_block = judged.filter("open AND whole").select("uid", F.shiftleft("first", 16).bitwiseOR(
        F.shiftleft(F.col("size").cast("long"), 8)).alias("place"))
    asked = judged.filter("NOT whole OR block = stands").select(F.col("block").alias("b"), "whole")
    each = written(blocks.join(asked, blocks["block"] == asked["b"])
                   .select("uid", "first", (F.col("open") & ~F.col("whole")).alias("asks"), F.posexplode("starts"))
                   .select("uid", (F.col("first") + F.col("pos")).alias("start"), "asks", F.col("col").alias("string")),
                   "substring-starts")
    twice = each.groupBy("string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("string")
    by_start = (each.filter("asks").join(twice, "string", "left_semi")
                .select("uid", F.shiftleft("start", 16).bitwiseOR(F.lit(256)).alias("place")))
    return settled.unionByName(by_block).unionByName(by_start)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: row (its own columns as a struct), n_bytes, n_removed, spans (begin and end
    of each removed run, in bytes) and kept (the bytes that remain).

    Null text counts as empty; texts shorter than 200 bytes keep every byte. Strings never cross
    documents; rows that repeat a whole row are occurrences of their own. An empty table gives
    none. Documents that hold no repeat pass straight through.
    """
    ship_package(docs.sparkSession)
    uid = F.xxhash64("doc_id", text_of())
    places = (settled_starts(docs.select(uid.alias("uid"), text_of().alias("text")))
              .groupBy("uid").agg(F.collect_list("place").alias("places")))
    places = written(places, "substring-places")
    _release(docs.sparkSession)
    keyed = docs.select(F.struct("*").alias("row"), uid.alias("uid"), text_of().alias("text"))
    touched = member_filter(places, "uid")
    spans_type = "array<struct<begin: bigint, end: bigint>>"
    alone = keyed.filter(~touched).select(
        "row", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.array().cast(spans_type).alias("spans"), F.col("text").cast("binary").alias("kept"))
    key = docs.schema.simpleString()
    hit = keyed.filter(touched).join(places.withColumnRenamed("uid", "uid_of"), F.col("uid") == F.col("uid_of"), "left")
    cut = (hit.select("row", "text", "places")
           .mapInArrow(cut_out, f"key {key}, n_bytes long, n_removed long, spans {spans_type}, kept binary")
           .withColumnRenamed("key", "row"))
    return alone.unionByName(cut)
