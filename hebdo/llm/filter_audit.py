"""What filters cost together: how many documents each removes, in every order of application.

The statistics come from a byte transducer that is driven by tables. It reads a text's UTF-8 once;
its states tell gaps from words and how many continuation bytes a character still lacks, and its
outputs count code points, capitals and symbols and mark where words begin. The spans of the words
go into a hash table that compares bytes before it takes two spans for the same word, so the count
of distinct words is exact.

The machine is run on a whole block of bytes at a time (numpy): every byte but a continuation byte
resets it to a state of its own, and a character has at most three of those, so the states of all
bytes are known after three look-ups.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hebdo.llm.common import ship_package, text_of, written
from hebdo.llm.textbytes import in_slices, mixed, stretches, text_bytes

U = np.uint64

# ------------------------------------------------------------------------- the transducer's tables
# classes of bytes
SPACE, CAPITAL, SYMBOL, PLAIN, MORE, LEAD2, LEAD3, LEAD4 = range(8)
N_CLASSES = 8
# states: between words; in a word with 0 to 3 continuation bytes to come
GAP, WORD, WORD1, WORD2, WORD3 = range(5)

CLASS = np.full(256, PLAIN, np.uint8)
CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = SPACE
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[[ord(c) for c in "#$%&*|"]] = SYMBOL
CLASS[0x80:0xC0], CLASS[0xC0:0xE0], CLASS[0xE0:0xF0], CLASS[0xF0:] = MORE, LEAD2, LEAD3, LEAD4

#: The state after a byte, where it does not depend on the state before.
RESET = np.array([GAP, WORD, WORD, WORD, WORD, WORD1, WORD2, WORD3], np.uint8)
#: The state after a continuation byte, by the state before (one too many stays a character's end).
AFTER_MORE = np.array([WORD, WORD, WORD, WORD1, WORD2], np.uint8)

# outputs, by state before and class: counters in fields of one number, a bit each
FIELD_BITS = 21
POINTS, CAPITALS, SYMBOLS = (U(1 << (FIELD_BITS * k)) for k in range(3))
OUT = np.zeros((5, N_CLASSES), U)
for _state in range(5):
    for _class in range(N_CLASSES):
        OUT[_state, _class] = ((POINTS if _class != MORE or _state in (GAP, WORD) else U(0))
                               + (CAPITALS if _class == CAPITAL else U(0)) + (SYMBOLS if _class == SYMBOL else U(0)))
BEGINS = np.zeros((5, N_CLASSES), bool)
BEGINS[GAP] = np.arange(N_CLASSES) != SPACE
#: Bytes summed at once, so that no counter leaves its field.
SUMMED = 1 << 20
#: Words inserted at once.
INSERTED = 1 << 18


def transduce(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over a block that starts in a gap. ``begins``: where texts begin, which are gaps too.
    Returns the outputs of all bytes and the words' first bytes and ends."""
    kind = CLASS[data]
    state = RESET[kind]
    more = np.flatnonzero(kind == MORE)
    more = more[more > 0]
    for _ in range(3):  # a character's bytes are settled one after another
        state[more] = AFTER_MORE[state[more - 1]]
    before = np.empty_like(state)
    before[0], before[1:] = GAP, state[:-1]
    before[begins] = GAP
    at = before * np.uint8(N_CLASSES) + kind
    in_word = state != GAP
    ends = np.flatnonzero(in_word[:-1] & (before[1:] == GAP) | in_word[:-1] & ~in_word[1:]) + 1
    if in_word[-1]:
        ends = np.append(ends, len(data))
    return OUT.ravel()[at], np.flatnonzero(BEGINS.ravel()[at]), ends


# ------------------------------------------------------------------------- the verified hash table
LANE = 8
LANES = 8  # spans of up to 64 bytes are hashed and compared in lanes of 8, longer ones one by one
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(LANE + 1)], U)


class SpanTable:
    """Open addressing over spans of one byte array. A span is taken for an entry only if its owner,
    its length and all of its bytes agree."""

    def __init__(self, data: np.ndarray):
        self.bytes = np.concatenate([data, np.zeros(LANE, np.uint8)])
        self.lanes = np.ndarray(len(data) + 1, "<u8", self.bytes, strides=(1,))
        self.n = 0
        self.begin, self.length, self.owner = (np.zeros(0, np.int64) for _ in range(3))
        self.hash = np.zeros(0, U)
        self.slots = np.full(1 << 10, -1, np.int64)

    def _lane(self, begin: np.ndarray, length: np.ndarray, k: int) -> np.ndarray:
        return self.lanes[begin + LANE * k] & _MASK[np.minimum(length - LANE * k, LANE)]

    def _raw(self, i: int) -> bytes:
        return self.bytes[self.begin[i]:self.begin[i] + self.length[i]].tobytes()

    def _hashes(self, begin: np.ndarray, length: np.ndarray, owner: np.ndarray) -> np.ndarray:
        h = (owner.astype(U) << U(32)) + length.astype(U)
        for k in range(LANES):
            at = slice(None) if k == 0 else np.flatnonzero(length > LANE * k)
            if k and not len(at):
                break
            x = (h[at] ^ self._lane(begin[at], length[at], k)) * U(0x9E3779B97F4A7C15)
            h[at] = x ^ (x >> U(29))
        for i in np.flatnonzero(length > LANE * LANES):
            h[i] ^= U(xxhash.xxh3_64_intdigest(self.bytes[begin[i]:begin[i] + length[i]]))
        return mixed(h)

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        same = (self.hash[a] == self.hash[b]) & (self.owner[a] == self.owner[b]) & (self.length[a] == self.length[b])
        for k in range(LANES):
            at = np.flatnonzero(same & (self.length[a] > LANE * k))
            if not len(at):
                break
            n = self.length[a[at]]
            same[at] = self._lane(self.begin[a[at]], n, k) == self._lane(self.begin[b[at]], n, k)
        for i in np.flatnonzero(same & (self.length[a] > LANE * LANES)):
            same[i] = self._raw(a[i]) == self._raw(b[i])
        return same

    def _place(self, ids: np.ndarray, verify: bool) -> np.ndarray:
        """Find each span's slot, all spans one probe at a time. Returns the slots, -1 for spans that
        equal an entry."""
        mask = len(self.slots) - 1
        slot = (self.hash[ids] & U(mask)).astype(np.int64)
        found = np.full(len(ids), -1, np.int64)
        open_ = np.arange(len(ids))
        while len(open_):
            s, who = slot[open_], ids[open_]
            free = self.slots[s] < 0
            self.slots[s[free]] = who[free]  # of several spans at a slot one wins
            there = self.slots[s]
            mine = there == who
            found[open_[mine]] = s[mine]
            left = ~mine
            if verify:
                rest = np.flatnonzero(left)
                left[rest[self._equal(who[rest], there[rest])]] = False
            open_ = open_[left]
            slot[open_] = (slot[open_] + 1) & mask
        return found

    def insert(self, begin: np.ndarray, length: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Insert spans; which of them are new entries? (of equal spans in one call, one is)"""
        n, m = self.n, len(begin)
        if n + m > len(self.begin):
            room = max(n + m, 2 * n)
            self.begin, self.length, self.owner, self.hash = (
                np.concatenate([x[:n], np.zeros(room - n, x.dtype)]) for x in (self.begin, self.length, self.owner, self.hash))
        if 2 * (n + m) > len(self.slots):
            self.slots = np.full(1 << int(4 * (n + m)).bit_length() - 1, -1, np.int64)
            self._place(np.arange(n), verify=False)
        tail = slice(n, n + m)
        self.begin[tail], self.length[tail], self.owner[tail] = begin, length, owner
        self.hash[tail] = self._hashes(begin, length, owner)
        found = self._place(np.arange(n, n + m), verify=True)
        new = found >= 0
        self.n = n + int(new.sum())
        for x in (self.begin, self.length, self.owner, self.hash):
            x[n:self.n] = x[tail][new]
        self.slots[found[new]] = np.arange(n, self.n)
        return new


COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def text_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The five counts of each text (null: empty)."""
    data, offsets = text_bytes(column)
    counts = {name: np.zeros(len(offsets) - 1, np.int64) for name in COUNTS}
    table = SpanTable(data)
    field = (1 << FIELD_BITS) - 1
    for a, b, begins in stretches(data, offsets):
        out, first, end = transduce(data[a:b], begins[begins < b] - a)
        cuts = np.unique(np.concatenate([begins - a, np.arange(0, b - a, SUMMED)]))
        sums = np.add.reduceat(out, cuts)
        of = np.searchsorted(offsets, cuts + a, "right") - 1  # of texts that begin at a byte the last, which has it
        for k, name in enumerate(("n_points", "n_capitals", "n_symbols")):
            np.add.at(counts[name], of, ((sums >> U(FIELD_BITS * k)) & U(field)).astype(np.int64))
        owner = np.searchsorted(offsets, first + a, "right") - 1
        counts["n_words"] += np.bincount(owner, minlength=len(offsets) - 1)
        for k in range(0, len(first), INSERTED):
            part = slice(k, k + INSERTED)
            new = table.insert(first[part] + a, end[part] - first[part], owner[part])
            counts["n_distinct"] += np.bincount(owner[part][new], minlength=len(offsets) - 1)
    return counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over (text, other columns): the other columns and the counts."""
    for batch in in_slices(batches):
        if batch.num_rows:
            counts = text_counts(batch.column(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, counts.values())],
                                             names=[*batch.schema.names[1:], *counts])


# ------------------------------------------------------------------------- the audit
def standard_filters() -> dict[str, Column]:
    """When a document fails each filter, by its counts (whole numbers only)."""
    return {"A": F.col("n_words") < 100, "B": 100 * F.col("n_distinct") < 80 * F.col("n_words"),
            "C": 100 * F.col("n_capitals") > 10 * F.col("n_points"), "D": F.col("n_symbols") > 0}


COPY_FILTER = "E"


def failures(docs: DataFrame, labels: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the filters that they fail, bit k of the mask
    for the k-th of ``filters`` and the next bit for copies of a smaller doc_id's text.

    Rows of one text and part are counted together before they meet the others, and labels meet
    one row per doc_id and text, so neither copies nor repeated rows gather in one task.
    """
    ship_package(docs.sparkSession)
    read = docs.select(text_of().alias("text"), "doc_id", F.coalesce("lang", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("print"))
    kind = read.schema["doc_id"].dataType.simpleString()
    counted = read.mapInArrow(_count, f"doc_id {kind}, part string, print binary, "
                              + ", ".join(f"{c} long" for c in COUNTS))
    mask = sum((F.when(fails, F.lit(1 << k)).otherwise(0) for k, fails in enumerate(filters.values())), F.lit(0))
    rows = written(counted.select("doc_id", "part", "print", mask.cast("int").alias("mask")), "audit-masks")
    rows = rows.groupBy("doc_id", "print", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic")))
    share = lambda flag: F.when(F.col(flag), F.col("n")).otherwise(0).cast("long")
    labelled = (rows.filter("doc_id IS NOT NULL").join(known, "doc_id", "left")
                .select("doc_id", "print", "part", "mask", "n", share("is_good").alias("good"), share("is_toxic").alias("toxic")))
    none = F.lit(0).cast("long")
    labelled = labelled.union(rows.filter("doc_id IS NULL").select("doc_id", "print", "part", "mask", "n", none, none))
    # of each text, the row with the smallest doc_id is no copy; a null one comes last
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")
    texts = labelled.groupBy("print", "part", "mask").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")], F.min(F.struct(first.alias("id"), "n", "good", "toxic")).alias("first"))
    lead = F.min("first.id").over(Window.partitionBy("print")).eqNullSafe(F.col("first.id"))  # a row per part
    texts = texts.select("*", lead.alias("leads"))
    copy_bit = 1 << len(filters)
    part_of = lambda c: F.when(F.col("leads"), F.col(f"first.{c}")).otherwise(none)
    split = F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), *[part_of(c).alias(c) for c in ("n", "good", "toxic")]),
        F.struct((F.col("mask") + copy_bit).alias("mask"), *[(F.col(c) - part_of(c)).alias(c) for c in ("n", "good", "toxic")])))
    return texts.select("part", split).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _orders(names: list[str]) -> str:
    """Every order and step as JSON: the step's bit and the bits applied before it."""
    rows = []
    for order in permutations(names):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << names.index(name)
            rows.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return json.dumps(rows)


def interactions(failed: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters and step, from the counts by mask (``failures``)."""
    size = 1 << len(names)
    has = lambda bits: F.col("mask").bitwiseAND(F.lit(bits)) != 0
    total = lambda when, value: F.sum(F.when(when, value).otherwise(0))
    by_bit = lambda make: F.map_from_arrays(F.array(*[F.lit(1 << k) for k in range(len(names))]),
                                            F.array(*[make(1 << k) for k in range(len(names))]))
    weight = F.expr(f"n * {factorial(len(names))} div bit_count(mask)")  # each of a document's filters is first equally often
    parts = failed.groupBy("part").agg(
        *[F.array(*[total(~has(bits), F.col(c)) for bits in range(size)]).alias(f"{c}_left") for c in ("n", "good", "toxic")],
        by_bit(lambda bit: total(has(bit), F.col("n"))).alias("fails"),
        by_bit(lambda bit: total(F.col("mask") == bit, F.col("n"))).alias("alone"),
        by_bit(lambda bit: total(has(bit), weight)).alias("shapley"))
    steps = F.from_json(F.lit(_orders(names)), "array<struct<filter_order: string, step: int, bit: int, before: int>>")
    rows = parts.select("*", F.inline(steps))
    left = lambda c, after: F.get(F.col(f"{c}_left"), F.col("before") + (F.col("bit") if after else 0))
    lost = lambda c: left(c, False) - left(c, True)
    out = {"kept": left("n", True), "removed": lost("n"), "redundant": F.col("fails")[F.col("bit")] - lost("n"),
           "unique_fails": F.col("alone")[F.col("bit")], "good_lost": lost("good"), "toxic_lost": lost("toxic"),
           "shapley": F.col("shapley")[F.col("bit")]}
    return rows.select("part", "filter_order", "step", *[c.cast("long").alias(name) for name, c in out.items()])


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None) -> DataFrame:
    """The cost of each filter at each place in every order: (part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley), a row per lang, order and step.

    ``filters`` (by default ``standard_filters``) name a condition on the counts of ``text_counts``, one
    letter each, five at most; copies of a smaller doc_id's text are one more filter. A null or
    empty text fails as its counts say and is a copy of any other empty text. A null lang is the
    part with the empty name. Rows that agree in doc_id and text are no copies of each other; a null
    doc_id is larger than any other and has no label. A doc_id with several labels is good or toxic if
    one of them says so. An empty table gives no rows. Other columns are not read.
    """
    filters = filters or standard_filters()
    if len(filters) > 5 or any(len(name) != 1 for name in (*filters, COPY_FILTER)):
        raise ValueError("at most five filters, named by one letter each")
    return interactions(failures(docs, labels, filters), [*filters, COPY_FILTER])
