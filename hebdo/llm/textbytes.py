"""Vectorised hashing of the words and shingles of Arrow text batches (numpy, no loop per word)."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
#: Bytes hashed at a time; the working arrays take about 50 times as much.
BLOCK = 1 << 20

_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(0, 2**64, 256, dtype=U)
_lower = np.arange(256)
_lower[ord("A"):ord("Z") + 1] += 32
LOWER_VALUE = BYTE_VALUE[_lower]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
POSITION = _rng.integers(0, 2**64, 64, dtype=U) | U(1)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** [0 .. n) modulo 2^64; kept, and grown when a longer run is asked for."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK + 1), base, dtype=U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows (no copies): what is made from a slice's texts
    is many times their size, and Spark keeps Python workers with the memory they have taken."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def give_back() -> None:
    """Return memory that nothing uses any more to the system: Spark keeps idle workers."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, one after another, and each text's offsets. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Cut the bytes into blocks of about BLOCK: (begin, end, offsets of texts that begin inside).
    Blocks end where a text ends or, in a long text, before white space."""
    at, n = 0, len(data)
    while at < n:
        end = at + BLOCK
        if end >= n:
            end = n
        else:
            last = offsets[np.searchsorted(offsets, end, "right") - 1]
            if last > at:
                end = int(last)
            else:
                while end < n:
                    spaces = np.flatnonzero(IS_SPACE[data[end:end + BLOCK]])
                    stop = int(offsets[np.searchsorted(offsets, end, "left")])
                    found = end + int(spaces[0]) if len(spaces) else min(end + BLOCK, n)
                    end = min(found, stop)
                    if len(spaces) or end == stop:
                        break
        yield at, end, offsets[np.searchsorted(offsets, at, "left"):np.searchsorted(offsets, end, "left")]
        at = end


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of each text, in order, and the texts' offsets into them."""
    data, offsets = text_bytes(column)
    values = LOWER_VALUE if lower else BYTE_VALUE
    hashes, starts_at = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for a, b, begins in stretches(data, offsets):
        part = data[a:b]
        space = IS_SPACE[part]
        before, after = np.empty_like(space), np.empty_like(space)
        before[0], before[1:] = True, space[:-1]
        before[begins - a] = True
        after[-1], after[:-1] = True, space[1:]
        after[begins[begins > a] - a - 1] = True
        first = np.flatnonzero(~space & before)
        last = np.flatnonzero(~space & after) + 1
        prefix = np.zeros(len(part) + 1, U)
        np.cumsum(values[part] * powers(BASE, len(part)), out=prefix[1:])
        h = (prefix[last] - prefix[first]) * powers(INVERSE, len(part))[first]
        hashes.append(mixed(h + (last - first).astype(U) * U(0xD6E8FEB86659FD93)))
        starts_at.append(first + a)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts_at), offsets, "left")


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words; with fewer words, of the whole sequence."""
    if not len(words):
        return words
    n = min(size, len(words))
    total = np.full(len(words) - n + 1, n, dtype=U)
    for k in range(n):
        total += words[k:len(words) - n + 1 + k] * POSITION[k]
    return mixed(total)
