"""Fill-in-middle examples: every text cut at two drawn places and reordered.

A text's UTF-8 bytes are seen as blocks of ``BLOCK`` bytes. A Fenwick tree over the blocks
keeps two sums a node, the units and the code points that start there. To cut before unit
k, a binary-lifting descent finds the block where that unit starts together with both sums
of all blocks before it; only that block's bytes are then searched for the boundary. A cut
so costs the logarithm of the text's length and one block. Units are code points, words or
lines; a unit reaches to the start of the next one, so that every cut is exact and lies
between code points.

Both places and the form are drawn from the SHA-256 of seed and ``doc_id``, not from a
generator, so that lost tasks give the same rows again. There is no shuffle; a task holds
the texts of one step (``textbytes.STEP_BYTES``, or one longer text).

Defined results: null and empty texts give plain, empty outputs; a null ``doc_id`` is drawn
as an empty one; rows with equal ``doc_id`` are drawn alike; texts with a mark in them stay
plain, as they could not be rebuilt; repeated rows give repeated rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb

BLOCK = 4096
MARKS = ("<P>", "<S>", "<M>")
UNITS = ("code point", "word", "line")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_MARK = re.compile(r"<[^<>]+>")


class Fenwick:
    """Prefix sums of several counts per block, and the descent to the block of the k-th unit."""

    def __init__(self, counts: np.ndarray) -> None:
        place = np.arange(1, len(counts) + 1)
        sums = np.zeros((len(counts) + 1, counts.shape[1]), np.int64)
        np.cumsum(counts, axis=0, out=sums[1:])
        self.total = sums[-1].tolist()
        self.nodes = (sums[1:] - sums[place - (place & -place)]).tolist()

    def descend(self, k: int) -> tuple[int, int, int]:
        """The block where unit ``k`` (from 0) starts, and the units and code points before that block.

        For ``k`` equal to the number of units, the number of blocks.
        """
        block = units = points = 0
        step = 1 << len(self.nodes).bit_length()
        while step := step >> 1:
            if block + step <= len(self.nodes):
                more, chars = self.nodes[block + step - 1]
                if units + more <= k:
                    block, units, points = block + step, units + more, points + chars
        return block, units, points


def unit_starts(data: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """Which bytes start a unit; the first byte of a text always does."""
    if unit == "code point":
        return (data & 0xC0) != 0x80
    begin = np.zeros(len(data), bool)
    if unit == "word":
        space = tb.SPACES[data]
        begin[1:] = space[:-1] & ~space[1:]
    elif unit == "line":
        begin[1:] = data[:-1] == 0x0A
    else:
        raise ValueError(f"unknown unit {unit!r}; use one of {UNITS}")
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    return begin


def block_counts(begin: np.ndarray, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units and code points that start in each block, and per text the index of its first block (n + 1)."""
    blocks = -(-np.diff(offsets) // BLOCK)
    firsts = np.concatenate([[0], np.cumsum(blocks)])
    starts = np.repeat(offsets[:-1], blocks) + BLOCK * (np.arange(firsts[-1]) - np.repeat(firsts[:-1], blocks))
    if not len(starts):
        return np.zeros((0, 2), np.int64), firsts
    return np.stack([np.add.reduceat(mask, starts, dtype=np.int64) for mask in (begin, points)], axis=1), firsts


def cut(tree: Fenwick, begin: np.ndarray, points: np.ndarray, k: int) -> tuple[int, int]:
    """Byte and code point, from the text's start, where unit ``k`` starts (the text's end for the number of units)."""
    block, units, chars = tree.descend(k)
    if block == len(tree.nodes):
        return len(begin), chars
    low = block * BLOCK
    within = int(np.flatnonzero(begin[low : low + BLOCK])[k - units])
    return low + within, chars + int(np.count_nonzero(points[low : low + within]))


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers."""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(hexed[i : i + 8], 16) for i in range(0, 32, 8)]


def middle_examples(
    docs: DataFrame, unit: str = "code point", seed: int = 1, rate: int = 90, suffix_first: int = 20, marks: Sequence[str] = MARKS
) -> DataFrame:
    """One row per document: doc_id, n units, form, prefix_chars, middle_chars and the output.

    Of all texts ``rate`` percent are reordered, and ``suffix_first`` percent of these in
    the form spm, else psm. ``marks`` stand before prefix, suffix and middle; they look like
    ``<name>``, so that none can arise where two parts meet.
    """
    marks = tuple(marks)
    if unit not in UNITS or len(set(marks)) != 3 or not all(_MARK.fullmatch(m) for m in marks):
        raise ValueError(f"unit must be one of {UNITS}, marks three different ones like <name>")
    p, s, m = (mark.encode() for mark in marks)

    def example(tree: Fenwick | None, text: bytes, begin: np.ndarray, points: np.ndarray, h: list[int]) -> tuple:
        n = tree.total[0] if tree else 0
        if not text or h[2] % 100 >= rate or p in text or s in text or m in text:
            return n, "plain", None, None, text
        (a, a_chars), (b, b_chars) = (cut(tree, begin, points, k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h[3] % 100 < suffix_first:
            return n, "spm", a_chars, b_chars - a_chars, b"".join((s, suffix, p, prefix, m, middle))
        return n, "psm", a_chars, b_chars - a_chars, b"".join((p, prefix, s, suffix, m, middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.steps(batch, "text"):
                data, offsets = tb.utf8(part.column("text"))
                points = unit_starts(data, offsets, "code point")
                begin = points if unit == "code point" else unit_starts(data, offsets, unit)
                counts, firsts = block_counts(begin, points, offsets)
                rows = []
                for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    here = slice(int(offsets[i]), int(offsets[i + 1]))
                    tree = Fenwick(counts[firsts[i] : firsts[i + 1]]) if firsts[i] < firsts[i + 1] else None
                    rows.append(example(tree, data[here].tobytes(), begin[here], points[here], draws(seed, doc_id)))
                n, form, prefix, middle, output = zip(*rows)
                columns = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
                columns = [part.column("doc_id").cast(pa.int64()), *columns, pa.array(output, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def restored(form: str | Column = "form", output: str | Column = "output", marks: Sequence[str] = MARKS) -> Column:
    """The text as it was, rebuilt from an output and its form alone."""
    form, output = (F.col(c) if isinstance(c, str) else c for c in (form, output))

    def parts(first: str, *others: str) -> Column:
        return F.split(output.substr(F.lit(len(first) + 1), F.length(output)), "|".join(map(re.escape, others)), -1)

    p, s, m = marks
    psm, spm = parts(p, s, m), parts(s, p, m)
    return (
        F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )
