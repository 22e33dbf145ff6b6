"""Whitening of embeddings by eigenvectors that are refined in mixed precision.

Entries become integers (floor(scale * c)), so sums and the covariance are exact: tasks centre the
vectors on the rounded mean before they multiply, matrix products of small integers in float64
lose nothing, and Spark adds the blocks as decimals. The driver holds one dimension x dimension
matrix. Its eigenvectors are found in float32 and corrected by Ogita-Aishima iterations, which
consist of matrix products, in float64 and then in extended precision. Eigenvalues too close for the
correction formula form clusters; each is settled by an eigenproblem of its own, shifted by its mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import ship_package, written
from hebdo.llm.textbytes import in_slices

#: Bits of one limb of an entry and rows of one block: products of limbs, summed over a block, stay
#: below 2^53, so float64 holds them exactly.
LIMB_BITS = 20
BLOCK_ROWS = 1 << 12
#: Blocks added up in 64-bit integers before they are handed on.
BLOCKS_HELD = 1 << 9
#: Entries of this size or more have no quantised value (their vectors are dropped).
TOO_LARGE = 2.0**52

LONGEST = np.longdouble


# ------------------------------------------------------------------------- exact statistics
def quantised(c: Column, scale: int) -> Column:
    """The vector as longs, null where it is null, empty, or holds null, non-finite or too large entries."""
    usable = F.forall(c, lambda e: e.isNotNull() & (F.abs(e.cast("double")) * scale < F.lit(TOO_LARGE * 256)))
    return F.when(usable & (F.size(c) > 0), F.transform(c, lambda e: F.floor(F.lit(float(scale)) * e.cast("double"))))


def matrix(column: pa.ListArray) -> np.ndarray:
    """The vectors of a batch as rows; all have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over x: (dim, n, total, low, high) of the task, a row per dimension."""
    n, total, low, high = 0, None, None, None
    for batch in in_slices(batches, BLOCK_ROWS):
        x = matrix(batch.column(0))
        if not len(x):
            continue
        # in two halves: neither sum of a block leaves 64 bits
        part = (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0).astype(object)
        n, total = n + len(x), part if total is None else total + part
        low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
        high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
    if n:
        d = len(total)
        yield pa.RecordBatch.from_pydict({"dim": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()),
                                          "total": _decimals(total), "low": pa.array(low), "high": pa.array(high)})


def limbs(y: np.ndarray, count: int) -> list[np.ndarray]:
    """y = the sum of limb[k] * 2^(LIMB_BITS * k), as float64 matrices of small integers."""
    sign, size, mask = np.sign(y), np.abs(y), (1 << LIMB_BITS) - 1
    return [(sign * ((size >> (LIMB_BITS * k)) & mask)).astype(np.float64) for k in range(count)]


def products(centre: np.ndarray, count: int):
    """mapInArrow over x: (power, i, products) with the exact sums of y_i * y_j for y = x - centre, in
    units of 2^(LIMB_BITS * power)."""

    def rows(sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        for power, by_row in enumerate(sums):
            yield pa.RecordBatch.from_pydict({"power": pa.array([power] * len(by_row), pa.int32()),
                                              "i": pa.array(range(len(by_row)), pa.int32()),
                                              "products": pa.array(list(by_row), pa.list_(pa.int64()))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, held = len(centre), 0
        sums = np.zeros((2 * count - 1, d, d), np.int64)
        for batch in in_slices(batches, BLOCK_ROWS):
            if not batch.num_rows:
                continue
            parts = limbs(matrix(batch.column(0)) - centre, count)
            for a, left in enumerate(parts):
                for b, right in enumerate(parts):
                    sums[a + b] += (left.T @ right).astype(np.int64)
            held += 1
            if held == BLOCKS_HELD:
                yield from rows(sums)
                sums[:], held = 0, 0
        if held:
            yield from rows(sums)

    return run


# ------------------------------------------------------------------------- eigenvectors
def _slices(m: np.ndarray, axis: int, bits: int, count: int) -> list[np.ndarray]:
    """m, by rows (axis 1) or columns (axis 0), as float64 slices of ``bits`` bits each."""
    out = []
    for _ in range(count):
        top = np.abs(m).max(axis=axis, keepdims=True).astype(np.float64)
        unit = np.exp2(np.ceil(np.log2(np.where(top > 0, top, 1))) - bits).astype(m.dtype)
        out.append((np.round(m / unit) * unit).astype(np.float64))
        m = m - out[-1]
    return out


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The matrix product in the matrices' precision. Extended precision goes through float64
    products of slices, each of which is exact, so it runs at the speed of float64."""
    if a.dtype == np.float64:
        return a @ b
    bits = (52 - int(np.ceil(np.log2(max(2, a.shape[1]))))) // 2
    count = -(-70 // bits)
    left, right = _slices(a, 1, bits, count), _slices(b, 0, bits, count)
    out = np.zeros((a.shape[0], b.shape[1]), a.dtype)
    for k in reversed(range(count)):  # small terms first
        for i in range(k + 1):
            out += left[i] @ right[k - i]
    return out


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, float]:
    """One Ogita-Aishima iteration in the precision of ``a``: better eigenvectors, by falling
    eigenvalue, and the size of the correction. Columns whose eigenvalues differ by less than the
    uncertainty are only made orthogonal by the formula; a sub-solve then turns them within
    their space."""
    norm = lambda m: float(np.linalg.norm(m.astype(np.float64), 2))
    ax = _times(a, x)
    order = np.argsort(-np.einsum("ij,ij->j", x, ax) / np.einsum("ij,ij->j", x, x), kind="stable")
    x, ax = x[:, order], ax[:, order]
    r = np.eye(len(a), dtype=a.dtype) - _times(x.T, x)
    s = _times(x.T, ax)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    unsure = 2 * (norm(off) + norm(a) * norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > unsure
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    x = x + _times(x, e)
    size = float(np.abs(e).max())
    for begin, end in _clusters(values, unsure):
        x[:, begin:end], turned = _settled(a, x[:, begin:end], values[begin:end])
        size = max(size, turned)
    return x, size


def _clusters(values: np.ndarray, unsure: float) -> Iterator[tuple[int, int]]:
    """Runs of two and more neighbours that lie no further apart than ``unsure``."""
    cuts = np.flatnonzero(np.r_[True, np.abs(np.diff(values)) > unsure, True])
    return ((int(b), int(e)) for b, e in zip(cuts[:-1], cuts[1:], strict=True) if e - b > 1)


def _settled(a: np.ndarray, z: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, float]:
    """A cluster's own eigenproblem: A shifted by the cluster's mean and restricted to its space is
    small, so its float64 solution tells eigenvalues apart that are equal in A's own scale."""
    mean = values.mean()
    t = _times(z.T, _times(a, z) - mean * z)
    t = (t + t.T) / 2
    size = np.abs(t).max()
    if not size > 0:
        return z, 0.0
    _, turn = np.linalg.eigh((t / size).astype(np.float64))
    turn = turn[:, ::-1]
    # how far from a permutation with signs the turn is: none is left once the cluster is settled
    return _times(z, turn.astype(a.dtype)), float(np.abs(np.abs(turn) - np.round(np.abs(turn))).max())


def eigenvectors(v: np.ndarray, most: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix given in extended
    precision. Each vector's entry of largest size is positive. Eigenvalues that are equal to the
    last digit have no vectors of their own: any basis of their space is returned."""
    scale = np.abs(v).max()
    if not scale > 0:
        return np.zeros(len(v), v.dtype), np.eye(len(v), dtype=v.dtype)
    a = v / scale
    _, x = np.linalg.eigh(a.astype(np.float32))
    x = x[:, ::-1].astype(np.float64)
    for kind, enough in ((np.float64, 1e-13), (LONGEST, 1e-18)):
        x, last = x.astype(kind), np.inf
        for _ in range(most):
            x, size = _corrected(a.astype(kind), x)
            if size <= enough or size >= last / 2 and last < 1e-9:
                break
            last = size
    for _ in range(2):  # turns within clusters leave a little: orthogonal to the last digit
        x = x + _times(x, np.eye(len(a), dtype=a.dtype) - _times(x.T, x)) / 2
    values = np.einsum("ij,ij->j", x, _times(a, x))
    order = np.argsort(-values, kind="stable")
    values, x = values[order] * scale, x[:, order]
    at = np.abs(x.astype(np.float64)).argmax(axis=0)
    return values, x * np.sign(x[at, np.arange(len(v))])


# ------------------------------------------------------------------------- the model
@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: vectors x (longs) -> their centred projections in units of the spread."""

    n: int                    # vectors of the fit list
    centre: np.ndarray        # rounded mean, longs
    shift: list[int]          # S - n * centre, so that n * x - S = n * (x - centre) - shift
    reach: int                # the largest |x - centre| of the fit list
    projection: np.ndarray    # dimension x components, eigenvector / sqrt(eigenvalue)
    explained: list[float]    # eigenvalue / trace, by component
    scale: int

    def project(self, y: np.ndarray) -> np.ndarray:
        off = np.array([s / self.n for s in self.shift])
        return (y.astype(np.float64) - off) @ self.projection

    def deviations(self, y: np.ndarray) -> pa.Array:
        """The sum over dimensions of (n*x - S)^2, exact; null beyond 38 digits."""
        worst = self.n * self.reach + max(map(abs, self.shift))
        if worst * worst * len(self.shift) < 1 << 63:
            z = self.n * y - np.array(self.shift, np.int64)
            return pa.array((z * z).sum(axis=1)).cast(pa.decimal128(38, 0))
        z = self.n * y.astype(object) - np.array(self.shift, object)
        sums = (z * z).sum(axis=1)
        return pa.array([Decimal(int(v)) if v < 10**38 else None for v in sums], pa.decimal128(38, 0))


def _gathered(fit: DataFrame) -> tuple[int, list[int], np.ndarray, int]:
    """n, S, the rounded mean and the largest distance of an entry from it."""
    found = sorted(fit.mapInArrow(column_sums, "dim int, n long, total decimal(38,0), low long, high long").groupBy("dim")
                   .agg(F.sum("n").alias("n"), F.sum("total").cast("string").alias("total"), F.min("low").alias("low"),
                        F.max("high").alias("high")).collect(), key=lambda r: r["dim"])
    n, sums = found[0]["n"], [int(r["total"]) for r in found]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    reach = max(max(r["high"] - c, c - r["low"]) for r, c in zip(found, centre, strict=True))
    return n, sums, np.array(centre, np.int64), reach


def covariance(fit: DataFrame, n: int, shift: list[int], centre: np.ndarray, reach: int) -> np.ndarray:
    """The covariance (divisor n) of the fit list, rounded once from its exact value to extended
    precision. What reaches the driver is one number per pair of dimensions."""
    d, count = len(centre), max(1, -(-reach.bit_length() // LIMB_BITS))
    sums = (fit.mapInArrow(products(centre, count), "power int, i int, products array<bigint>")
            .select("power", "i", F.posexplode("products").alias("j", "product"))
            .groupBy("power", "i", "j").agg(F.sum(F.col("product").cast("decimal(38,0)")).cast("string").alias("total")))
    gram = np.zeros((d, d), object)
    for power, i, j, total in zip(*(c.to_pylist() for c in sums.toArrow().columns), strict=True):
        gram[i, j] += int(total) << (LIMB_BITS * power)
    t = np.array(shift, object)
    exact = n * gram - np.outer(t, t)
    return exact.astype(LONGEST) / LONGEST(n) / LONGEST(n)


def whitened_sums(model: Whitening):
    """mapInArrow over x: the whitened vectors' count, sums and sums of products in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.projection.shape[1]
        sums = np.zeros((k + 1, k))
        for batch in in_slices(batches, BLOCK_ROWS):
            if batch.num_rows:
                w = model.project(matrix(batch.column(0)) - model.centre)
                sums += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(sums.size), pa.int32()), "total": pa.array(sums.ravel())})

    return run


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of (covariance of the whitened fit list - identity), measured by a pass
    over the fit list."""
    k = model.projection.shape[1]
    found = fit.mapInArrow(whitened_sums(model), "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    sums = np.zeros((k + 1) * k)
    for r in found.collect():
        sums[r["at"]] = r["total"]
    sums = sums.reshape(k + 1, k) / model.n
    return float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(k)).max())


def _vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, x) of the rows that count: usable vectors of the most frequent length (of equally
    frequent ones, the longest)."""
    q = df.select(F.col(id_col).alias("id"), quantised(F.col(vector_col), scale).alias("x")).filter("x IS NOT NULL")
    size = q.groupBy(F.size("x").alias("d")).count().agg(F.max(F.struct("count", "d"))).first()[0]
    return q.filter(F.size("x") == (size["d"] if size else 0))


def fit(x: DataFrame, components: int | None = 4, scale: int = 256) -> tuple[DataFrame, Whitening] | None:
    """(fit list, model) of the distinct vectors of ``x`` (column x); None when there is no
    direction to whiten: no vectors, or all of them equal."""
    ship_package(x.sparkSession)
    fit_list = written(x.select("x").distinct(), "whitening-fit")  # a hot vector is reduced before the shuffle
    if fit_list.isEmpty():
        return None
    n, sums, centre, reach = _gathered(fit_list)
    shift = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    v = covariance(fit_list, n, shift, centre, reach)
    values, vectors = eigenvectors(v)
    # eigenvalues that double precision cannot tell from zero have no component
    rank = int((values > len(v) * 2.0**-52 * values[0]).sum())
    k = rank if components is None else min(components, rank)
    if not k:
        return None
    trace = np.trace(v)
    return fit_list, Whitening(n, centre, shift, reach, (vectors[:, :k] / np.sqrt(values[:k])).astype(np.float64),
                               [float(e / trace) for e in values[:k]], scale)


OUT = "id {id}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int | None = 4,
           scale: int = 256) -> DataFrame:
    """The rows' whitened vectors: (``id_col``, n, deviation, whitened, explained, identity_error).

    Each entry c becomes x = floor(scale * c). The whitening is fitted to the distinct vectors,
    each once, and applied to every row, repeated ones too; a null id is an id like any other.
    ``whitened`` and ``explained`` hold an entry per component, by falling eigenvalue: ``components``
    of them, or fewer where the covariance has a smaller rank. ``deviation`` is the exact sum of
    (n*x - S)^2, null beyond 38 digits. Dropped are null and empty vectors, vectors with null,
    non-finite or too large entries (2^52 and more in size), and those of another length than the
    most frequent. An empty table, or one whose vectors are all equal, gives no rows. Other columns
    are not read.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    rows = _vectors(df, id_col, vector_col, scale)
    fitted = fit(rows, components, scale)
    if fitted is None:
        return spark.createDataFrame([], OUT.format(id=kind)).withColumnRenamed("id", id_col)
    fit_list, model = fitted
    error = identity_error(fit_list, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, BLOCK_ROWS):
            if not batch.num_rows:
                continue
            y = matrix(batch.column(1)) - model.centre
            same = lambda v, t, m=len(y): pa.array([v] * m, t)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), same(model.n, pa.int64()), model.deviations(y),
                 pa.array(list(model.project(y)), pa.list_(pa.float64())),
                 same(model.explained, pa.list_(pa.float64())), same(error, pa.float64())],
                names=["id", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(run, OUT.format(id=kind)).withColumnRenamed("id", id_col)
