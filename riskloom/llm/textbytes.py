"""Vectorised work on the UTF-8 bytes of Arrow text columns (numpy, inside tasks).

A batch of texts is seen as one byte buffer with offsets; words are spans of that
buffer, and each gets a 64-bit hash from prefix sums. Nothing here knows Spark.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; one longer text makes a larger step.
STEP_BYTES = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed 64-bit values; another salt gives other ones."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt) * np.uint64(0x10001)) * _GOLDEN)


def lowered(table: np.ndarray) -> np.ndarray:
    """The byte table that sees A-Z as a-z."""
    out = table.copy()
    out[65:91] = table[97:123]
    return out


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` bytes in ``column``, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, first = np.cumsum(sizes), 0
    while first < len(sizes):
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a text column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without separators, and per text the index of its first run (n + 1)."""
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    finish[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


Batches = Iterator[pa.RecordBatch]
#: Bytes of input from which on a task's leftovers are worth the time of giving them back.
FREED_BYTES = 4 << 20


@cache
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library than glibc
        return lambda _: 0


def freeing(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work``, after which a worker that has seen much data gives its unused memory back, as Spark keeps it for later tasks."""

    def run(batches: Batches) -> Batches:
        seen = 0

        def counted() -> Batches:
            nonlocal seen
            for batch in batches:
                seen += batch.nbytes
                yield batch

        yield from work(counted())
        if seen >= FREED_BYTES:
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return run


class Powers:
    """Powers of one odd multiplier and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self, multiplier: int) -> None:
        self.bases = multiplier | 1, pow(multiplier | 1, -1, 1 << 64)
        self.tables = [np.ones(1, np.uint64)] * 2

    def __call__(self, n: int) -> list[np.ndarray]:
        if n > len(self.tables[0]):
            n = max(1 << 16, n + n // 4)
            for i, base in enumerate(self.bases):
                values = np.full(n, base, np.uint64)
                values[0] = 1
                self.tables[i] = np.cumprod(values, dtype=np.uint64)
        return self.tables


class Hasher:
    """64-bit hashes of byte spans: sums of table[byte] * m^place, moved to place 0, then mixed.

    Hashers differ in their tables; the powers are the worker's, once for all.
    """

    _powers = Powers(int(seeds(1, 7)[0]))

    def __init__(self, salt: int, lower: bool = False) -> None:
        table = seeds(256, salt)
        self.table = lowered(table) if lower else table

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        powers, inverses = self._powers(len(data) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.table[data] * powers[: len(data)], out=sums[1:])
            return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64) * _GOLDEN)


def shingles(words: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row, and per text the index of its first one (n + 1).

    A text with 1 to ``width`` - 1 words has one shingle, the whole sequence.
    """
    n = np.diff(firsts)
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    begins = np.concatenate([[0], np.cumsum(counts)])
    place = np.repeat(firsts[:-1], counts) + np.arange(begins[-1]) - np.repeat(begins[:-1], counts)
    length = np.repeat(np.minimum(n, width), counts)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    with np.errstate(over="ignore"):
        out = length.astype(np.uint64) * _GOLDEN
        for k in range(width):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + np.where(k < length, padded[place + k], np.uint64(0)))
    return out, begins
