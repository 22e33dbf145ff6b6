"""Near-duplicate groups: one-permutation MinHash, banded buckets, star-shaped candidates.

1. Each document's set of word shingles is hashed; equal sets form a class (large groups of
   copies are one class from here on). A class has one signature: the smallest hash in each of
   ``BINS`` bins of one permutation; an empty bin takes the value of a filled one that a fixed
   sequence of hash draws finds (optimal densification).
2. Bands of the signature are bucket keys. In a bucket the most central class is the hub of a
   star, and each class is also paired with its nearest one: at most two candidates a member.
3. Candidates are compared on the full shingle sets, with integers; links give components.
4. A star can miss a link between two of its points. So, for buckets that still hold several
   components, pairs across components are looked at too, unless the signatures rule them out or
   what the two share with the hub does: sets that differ from the hub's in unlike amounts
   cannot be close to each other. A bucket of one component needs no more pairs. What stays
   plausible joins classes to families over all buckets, and a family's members are compared on full
   sets inside tasks: a set is moved once per block of its family, not per bucket, and no pair is
   emitted that isn't needed to join what is linked. Large buckets are dealt out as pairs of blocks of
   bounded rows, large families as pairs of blocks of bounded bytes. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hebdo.llm.common import ship_package, written
from hebdo.llm.textbytes import U, in_slices, mixed, shingle_hashes, word_hashes

SHINGLE_WORDS = 5
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 75
BINS = 128
ROWS_PER_BAND = 4  # 32 bands: a pair at 0.75 shares no bucket with probability 5e-6
#: Pairs whose estimate is so many standard deviations below the threshold are ruled out.
SIGMAS = 4.0
#: Members of a bucket whose signatures one task compares at a time.
BLOCK = 1024
#: Bytes of shingle sets in a block; two blocks meet in a task.
SET_BYTES = 8 << 20
#: Groups that the partners of one hub are dealt out to.
SHARDS = 64

_EDGES = (np.arange(BINS, dtype=U) << U(57))
_DRAWS = np.random.default_rng(77).integers(0, BINS, (8192, BINS), dtype=np.int64)


def signature(distinct: np.ndarray) -> np.ndarray:
    """BINS 16-bit values from sorted distinct hashes (not empty)."""
    at = np.searchsorted(distinct, _EDGES)
    value = distinct[np.minimum(at, len(distinct) - 1)]
    filled = (at < len(distinct)) & (value >> U(57) == np.arange(BINS, dtype=U))
    out = (value & U(0xFFFF)).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    draw = 0
    while len(empty) and draw < len(_DRAWS):
        step = 32 if draw < 256 else 512
        found = filled[_DRAWS[draw:draw + step, empty]]
        has = found.any(axis=0)
        donors = _DRAWS[draw + found.argmax(axis=0)[has], empty[has]]
        out[empty[has]] = out[donors]
        empty = empty[~has]
        draw += step
    if len(empty):
        out[empty] = out[np.flatnonzero(filled)[0]]
    return out


def set_key(distinct: np.ndarray) -> bytes:
    """128 bits that equal sets share: two independent sums over the elements' hashes."""
    a = mixed(distinct ^ U(0x5851F42D4C957F2D)).sum(dtype=U)
    b = mixed(distinct + U(0x14057B7EF767814F)).sum(dtype=U)
    return a.tobytes() + b.tobytes()


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, class_id, n_shingles, sig (8 bits a bin), bands."""
    salt = mixed(np.arange(1, BINS // ROWS_PER_BAND + 1, dtype=U))
    for batch in in_slices(batches):
        words, at = word_hashes(batch.column(1))
        n, keys, sigs, bands = [], [], [], []
        for a, b in zip(at[:-1], at[1:], strict=True):
            distinct = np.unique(shingle_hashes(words[a:b], SHINGLE_WORDS))
            n.append(len(distinct))
            if not len(distinct):
                keys.append(None), sigs.append(None), bands.append(None)
                continue
            values = signature(distinct)
            keys.append(set_key(distinct))
            sigs.append((values & 0xFF).astype(np.uint8).tobytes())
            bands.append(mixed(values.view(U) ^ salt).view(np.int64))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "class_id": pa.array(keys, pa.binary()), "n_shingles": pa.array(n, pa.int64()),
            "sig": pa.array(sigs, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64()))})


def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """class_id, text -> class_id, shingles, for texts of that class (an id may have others)."""
    for batch in in_slices(batches):
        words, at = word_hashes(batch.column(1))
        keys, sets = [], []
        for key, a, b in zip(batch.column(0).to_pylist(), at[:-1], at[1:], strict=True):
            distinct = np.unique(shingle_hashes(words[a:b], SHINGLE_WORDS))
            if len(distinct) and set_key(distinct) == key:
                keys.append(key), sets.append(distinct.view(np.int64))
        yield pa.RecordBatch.from_pydict({"class_id": pa.array(keys, pa.binary()),
                                          "shingles": pa.array(sets, pa.list_(pa.int64()))})


def _plausible(agree: np.ndarray, n: int, others: np.ndarray) -> np.ndarray:
    """Can sets of ``n`` and ``others`` shingles reach the threshold, given the agreeing bins?"""
    small, large = np.minimum(n, others), np.maximum(n, others)
    seen = BINS * (1 - np.exp(-small / BINS))  # bins with a value of their own
    t = PERCENT / 100
    lowest = t - SIGMAS * np.sqrt(t * (1 - t) / np.maximum(seen, 1.0))
    return (agree >= lowest * BINS) & (100 * small >= PERCENT * large)


def _values(column: pa.Array) -> list:
    """The column's values; lists of numbers as numpy arrays."""
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b].copy() for a, b in zip(at[:-1], at[1:], strict=True)]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows sorted by their first column -> (value, the other columns as lists), value by value."""
    value, held = None, []
    for batch in in_slices(batches, 1024):
        for row in zip(*map(_values, batch.columns), strict=True):
            if row[0] != value:
                if len(held) > 1:
                    yield value, list(zip(*held, strict=True))[1:]
                value, held = row[0], []
            held.append(row)
    if len(held) > 1:
        yield value, list(zip(*held, strict=True))[1:]


def _signatures(sigs: tuple[bytes, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), BINS)


def hubs_and_nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, bucket, class_id, n_shingles, sig) sorted by group -> bucket, a, b, weight: the
    most central class of each group (b null, weight its mean agreement) and each class (a) with
    its nearest one that is plausible (b)."""
    buckets, a, b, weights = [], [], [], []
    schema = pa.schema([("bucket", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("weight", pa.float64())])
    for _, (bucket, ids, n, sigs) in _groups(batches):
        n, sig = np.array(n), _signatures(sigs)
        total, nearest = np.zeros(len(n)), set()
        for i in range(len(n)):
            agree = (sig == sig[i]).sum(axis=1).astype(float)
            total[i] = agree.sum()
            agree[~_plausible(agree, n[i], n)] = -1
            agree[i] = -1
            if agree.max() >= 0:
                nearest.add((i, int(agree.argmax())))
        hub = int(total.argmax())
        for x, y, w in [(ids[hub], None, total[hub] / len(n)), *((ids[i], ids[j], 0.0) for i, j in sorted(nearest))]:
            buckets.append(bucket[0]), a.append(x), b.append(y), weights.append(w)
        if len(a) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((buckets, a, b, weights), schema.types, strict=True)], schema=schema)
            buckets, a, b, weights = [], [], [], []
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((buckets, a, b, weights), schema.types, strict=True)], schema=schema)


def _cross(n, sig, side, comp, common) -> Iterator[tuple[int, np.ndarray]]:
    """Member and later members of other components (and of the other block, where two meet) that
    it can be linked with. ``common`` is how many shingles a class shares with the bucket's
    hub: two classes share at most what both can inside the hub's set and outside it. ``comp`` holds
    numbers; the caller may join some of them between two members."""
    two = side.any() and not side.all()
    for i in range(len(n) - 1):
        j = np.flatnonzero((comp[i + 1:] != comp[i]) & (side[i + 1:] != side[i] if two else True)) + i + 1
        most = np.minimum(common[j], common[i]) + np.minimum(n[j] - common[j], n[i] - common[i])
        j = j[100 * most >= PERCENT * (n[j] + n[i] - most)]
        j = j[_plausible((sig[j] == sig[i]).sum(axis=1), n[i], n[j])]
        if len(j):
            yield i, j


def _joined(comp: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Join the components of ``others`` with that of ``i`` (in place); one of ``others`` for each
    component that was another."""
    numbers, at = np.unique(comp[others], return_index=True)
    new = numbers != comp[i]
    comp[np.isin(comp, numbers[new])] = comp[i]
    return others[at[new]]


def _edges(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([min(x, y) for x, y in zip(a, b, strict=True)], pa.binary()),
                                       "b": pa.array([max(x, y) for x, y in zip(a, b, strict=True)], pa.binary())})


def _columns(columns: list) -> tuple:
    """The columns of a group as arrays: ids, n, signatures, side, component numbers, common."""
    ids, n, sigs, side, comp, common = columns[:6]
    return (ids, np.array(n), _signatures(sigs), np.array(side, dtype=bool),
            np.unique(np.array(comp, dtype=object), return_inverse=True)[1], np.array(common))


MEMBERS = "grp long, class_id binary, n_shingles long, sig binary, side boolean, comp binary, common long"


def plausible_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of MEMBERS sorted by group -> a, b: what plausible pairs across components join, as stars
    around the smallest id (not every pair), so that the same edges come from many groups."""
    a, b = [], []
    for _, columns in _groups(batches):
        ids, n, sig, side, comp, common = _columns(columns)
        tree = np.arange(len(n))
        for i, js in _cross(n, sig, side, comp, common):
            _joined(tree, i, js)
        smallest: dict[int, bytes] = {}
        for k in sorted(range(len(ids)), key=ids.__getitem__):
            if smallest.setdefault(int(tree[k]), ids[k]) != ids[k]:
                a.append(smallest[int(tree[k])]), b.append(ids[k])
        if len(a) > 10_000:
            yield _edges(a, b)
            a, b = [], []
    yield _edges(a, b)


def cross_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of MEMBERS and shingles, sorted by group -> a, b: links across components, as many as
    join what is linked (a forest, not every link). Each member is counted against all it may be
    linked with at once."""
    a, b = [], []
    for _, columns in _groups(batches):
        ids, n, sig, side, comp, common = _columns(columns)
        ends = np.cumsum(n)
        every = np.unique(np.concatenate(columns[6]), return_inverse=True)[1].astype(np.int32)
        mark = np.zeros(int(every.max()) + 1, dtype=bool)
        for i, js in _cross(n, sig, side, comp, common):
            mine = every[ends[i] - n[i]:ends[i]]
            mark[mine] = True
            if 4 * len(js) > len(n):
                shared = np.add.reduceat(mark[every], ends - n, dtype=np.int64)[js]
            else:
                shared = np.array([np.count_nonzero(mark[every[ends[j] - n[j]:ends[j]]]) for j in js])
            mark[mine] = False
            for j in _joined(comp, i, js[100 * shared >= PERCENT * (n[js] + n[i] - shared)]):
                a.append(ids[i]), b.append(ids[j])
    yield _edges(a, b)


def sets_of(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """class_id, shingles (the full set) of the classes in ``ids`` (class_id, repeats allowed)."""
    needed = ids.distinct().join(classes, "class_id").select("class_id", "rep")
    texts = docs.select("doc_id", "text").join(needed, F.col("doc_id").eqNullSafe(F.col("rep")))
    return written(texts.select("class_id", "text")
                   .mapInArrow(shingle_sets, "class_id binary, shingles array<bigint>"), "minhash-sets")


def compare_with_lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lead, shard, role, class_id, shingles) sorted by the first three: a lead's own set (role
    0), then those that it is compared with -> a, b, common, linked. One set is held."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("common", pa.int64()), ("linked", pa.bool_())])
    held = np.zeros(0, U)
    for batch in in_slices(batches, 256):
        rows = []
        for lead, _, role, other, shingles in zip(*map(_values, batch.columns), strict=True):
            own = shingles.view(U)
            if role == 0:
                held = own
                continue
            at = np.minimum(np.searchsorted(held, own), len(held) - 1)
            common = int((held[at] == own).sum())
            rows.append((min(lead, other), max(lead, other), common,
                         100 * common >= PERCENT * (len(held) + len(own) - common)))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def compared(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """a, b, common (shingles that both full sets hold), linked, of the pairs (lead, other).

    A lead may have any number of partners: they are dealt out over ``SHARDS`` groups, each with
    one copy of the lead's set, which is not copied to the pairs' rows."""
    dealt = pairs.withColumn("shard", F.pmod(F.xxhash64("other"), F.lit(SHARDS)).cast("int"))
    sets = sets_of(pairs.select(F.col("lead").alias("class_id")).union(pairs.select("other")), classes, docs)
    rows = lambda df, key, role: (df.join(sets, df[key] == sets["class_id"])
                                  .select("lead", "shard", F.lit(role).alias("role"), "class_id", "shingles"))
    return written(rows(dealt, "other", 1).union(rows(dealt.select("lead", "shard").distinct(), "lead", 0))
                   .repartition("lead", "shard").sortWithinPartitions("lead", "shard", "role")
                   .mapInArrow(compare_with_lead, "a binary, b binary, common long, linked boolean")
                   .distinct(), "minhash-compared")  # a document may be there twice


def components(links: DataFrame) -> DataFrame:
    """node, comp: the smallest node reachable over links (a, b), for nodes that have any.

    Each round lets every node point at its smallest neighbour (or at itself), follows the pointers to their
    ends, which doubles the reach of a step, and contracts the links to the ends. A round at
    least halves the nodes that still have links, so links are joined a few times over and rounds are
    logarithmic in number. What is between is written tables; the driver sees whether any is empty.
    """
    kind = links.schema["a"].dataType
    edges = written(links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                    "components-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        ends = written(both.groupBy("node").agg(F.min("other").alias("other"))
                       .select("node", F.least("node", "other").alias("comp")), "components-pointers")
        while True:
            further = ends.select(F.col("node").alias("comp"), F.col("comp").alias("end"))
            step = written(ends.join(further, "comp").select("node", F.col("end").alias("comp"), (F.col("end") != F.col("comp")).alias("moved")),
                           "components-pointers")
            ends = step.select("node", "comp")
            if step.filter("moved").isEmpty():
                break
        if labels is None:
            labels = ends
        else:  # nodes whose end got a smaller one
            more = ends.select(F.col("node").alias("comp"), F.col("comp").alias("end"))
            labels = written(labels.join(more, "comp", "left").select("node", F.coalesce("end", "comp").alias("comp")), "components-labels")
        of = lambda name: ends.select(F.col("node").alias(name), F.col("comp").alias(f"end_{name}"))
        edges = written(edges.join(of("a"), "a").join(of("b"), "b").filter("end_a != end_b")
                        .select(F.least("end_a", "end_b").alias("a"), F.greatest("end_a", "end_b").alias("b")).distinct(),
                        "components-edges")
    if labels is None:
        schema = StructType([StructField("node", kind), StructField("comp", kind)])
        return links.sparkSession.createDataFrame([], schema)
    return labels


def all_links(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """a, b of the links that connect the classes: stars first, then what a star can miss."""
    rows = classes.select("class_id", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(rows.join(sizes, "bucket")
                      .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
                      .withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")),
                      "minhash-members")
    sketched = classes.select("class_id", "n_shingles", "sig")
    found = written(
        members.join(sketched, "class_id")
        .select(F.xxhash64("bucket", "own").alias("grp"), "bucket", "class_id", "n_shingles", "sig")
        .repartition("grp").sortWithinPartitions("grp")
        .mapInArrow(hubs_and_nearest, "bucket long, a binary, b binary, weight double"), "minhash-hubs")
    hubs = (found.filter("b IS NULL").groupBy("bucket")
            .agg(F.max(F.struct("weight", F.col("a").alias("hub"))).getField("hub").alias("hub")))
    stars = members.join(hubs, "bucket").select("bucket", "class_id", "hub", "blocks", "own")
    stars = written(stars, "minhash-stars")
    # each member is compared with its bucket's hub and with its nearest; the hub, or the nearest, leads
    pairs = stars.filter("class_id != hub").select(F.col("hub").alias("lead"), F.col("class_id").alias("other"))
    pairs = pairs.union(found.filter("b IS NOT NULL").select(F.col("b").alias("lead"), F.col("a").alias("other")))
    pairs = written(pairs.groupBy(F.least("lead", "other").alias("a"), F.greatest("lead", "other").alias("b"))
                    .agg(F.min(F.struct("lead", "other")).alias("pair")).select("pair.*"), "minhash-pairs")
    first = compared(pairs, classes, docs)
    links = first.filter("linked").select("a", "b")

    comps = components(links)
    labelled = written(stars.join(comps, stars["class_id"] == comps["node"], "left").select(
        "bucket", "class_id", "hub", "blocks", "own", F.coalesce("comp", "class_id").alias("comp")), "minhash-labelled")
    unsettled = (labelled.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .filter("lo != hi").select("bucket"))
    # what the signatures leave plausible joins classes to families; a large bucket is dealt out by pairs
    # of its blocks, and no shingle set is moved
    dealt = (labelled.join(unsettled, "bucket", "left_semi")
             .withColumn("a", F.least("class_id", "hub")).withColumn("b", F.greatest("class_id", "hub"))
             .join(first.select("a", "b", "common"), ["a", "b"], "left")
             .join(sketched, "class_id")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    edges = written(
        dealt.select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("grp"),
                     "class_id", "n_shingles", "sig", (F.col("own") > F.col("other")).alias("side"), "comp",
                     F.coalesce(F.col("common"), F.col("n_shingles")).cast("long").alias("common"))
        .repartition("grp").sortWithinPartitions("grp").mapInArrow(plausible_edges, "a binary, b binary").distinct(),
        "minhash-plausible")
    if edges.isEmpty():
        return links
    # the members of a family are compared on full sets, each pair once whatever buckets it shares; a
    # large family is dealt out by pairs of blocks of bounded bytes
    family = components(edges).select(F.col("node").alias("class_id"), F.col("comp").alias("family"))
    family = written(family.join(sketched, "class_id").join(
        comps, F.col("class_id") == comps["node"], "left").select(
        "family", "class_id", "n_shingles", "sig", F.coalesce("comp", "class_id").alias("comp")), "minhash-families")
    blocks = family.groupBy("family").agg(F.ceil(F.sum("n_shingles") * 8 / SET_BYTES).cast("int").alias("blocks"))
    meet = (family.join(blocks, "family")
            .withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other")).alias("grp"), "class_id",
                    "n_shingles", "sig", (F.col("own") > F.col("other")).alias("side"), "comp",
                    F.col("n_shingles").alias("common")))
    sets = sets_of(family.select("class_id"), classes, docs)
    more = written(meet.join(sets, "class_id").select(*meet.columns, "shingles")
                   .repartition("grp").sortWithinPartitions("grp").mapInArrow(cross_links, "a binary, b binary"),
                   "minhash-more")
    return links.union(more)


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Null or empty text, or one without words: an empty set, linked with nothing. A null doc_id
    is never the smallest unless its group has no other. Rows with equal doc_id and text share
    their group and are all kept or not; where an id has several texts, each is in its own
    group. An empty table gives none; other columns are not read.
    """
    ship_package(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    sketches = written(docs.select("doc_id", "text").mapInArrow(
        sketch, f"doc_id {id_type}, class_id binary, n_shingles long, sig binary, bands array<bigint>"),
        "minhash-sketches")
    filled = sketches.filter("n_shingles > 0")
    classes = written(filled.groupBy("class_id").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"),
        F.first("bands").alias("bands")), "minhash-classes")
    links = all_links(classes, docs)
    comps = components(links)
    smallest = written(
        classes.join(comps, classes["class_id"] == comps["node"], "left")
        .select("class_id", "rep", F.coalesce("comp", "class_id").alias("comp")), "minhash-components")
    ids = smallest.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_class = smallest.join(ids, "comp").select(F.col("class_id").alias("cls"), "component_id")
    none = F.col("n_shingles") == 0
    component: Column = F.when(none, F.col("doc_id")).otherwise(F.col("component_id"))
    return (sketches.select("doc_id", "class_id", "n_shingles")
            .join(by_class, F.col("class_id") == F.col("cls"), "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.col("doc_id").eqNullSafe(component).alias("kept")))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest doc_id. A doc_id goes
    only if none of its rows is kept."""
    gone = (near_groups(docs).groupBy(F.col("doc_id").alias("gone_id")).agg(F.max("kept").alias("kept"))
            .filter("NOT kept").select("gone_id"))
    return (docs.select(F.struct("*").alias("row"), "doc_id")
            .join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti").select("row.*"))
