"""Fuzzy line deduplication: gram sketches, buckets, edit similarity, connected groups.

A line is normalised: A-Z lower-cased, digits read as 0, every run of other ASCII
characters one space. Lines with fewer than ``min_words`` words stay untouched, and so
does a line without any. Equal normalised lines are one class. Two classes are linked if
their edit similarity (1 - Levenshtein distance / longer length, of the normalised lines'
bytes) is at least ``similarity``. Of each connected group the occurrence with the
smallest (doc_id, line number) stays.

Candidates come from buckets. With a shorter line of ``SHORT`` bytes at most, the pieces
of its length (one more than edits may be) are looked up at every place to which the
edits can move them, so no pair is missed; letter counts, which an edit changes by two
at most, sieve them. Longer lines have a sketch of ``COORDS`` minima over runs of
``GRAM`` bytes, of which an edit touches ``GRAM``; lines of like length that agree in one
of ``TRIPLES`` and in ``AGREE`` coordinates are candidates. README has the measured
recall, and why a SimHash can't take the place of the sketch. Candidate pairs alone are
compared, by the counts of their bytes, which tell most of them apart, and then by edit distance: first a few that span each group of
like lines, then, of all pairs under all keys, those whose lines are not joined yet.
A pair that is left out is of two lines joined already, so it can't change a group.

Defined results: null text stays null, has no lines; empty lines stay; a document may lose all its lines
and then has an empty text; rows that share a ``doc_id`` are one document and a line at
the same place in them is one occurrence; rows with a null ``doc_id`` take no part and
stay as they are. Only ``doc_id`` and ``text`` are read; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.tables import BROADCAST_ROWS, PACKED_BATCH_ROWS, SPARK_BATCH_ROWS, Scratch, components, freed, narrow_batches, small

SHORT, GRAM, COORDS, AGREE = 39, 5, 32, 10
#: Bytes of text whose lines are hashed at once; their sums stay in a core's cache.
STEP_BYTES = 1 << 18
#: Coordinates of the buckets; so many of them are dealt at once.
TRIPLES, AT_ONCE = np.concatenate([np.argsort(tb.seeds(COORDS, 31 + i))[:30].reshape(-1, 3) for i in range(4)])[:32], 4
#: Bytes of entries that a task collects before it packs them, and about those of a bucket; buckets, at least and at most.
HELD_BYTES, BUCKET_BYTES, BUCKETS = 16 << 20, 2 << 20, (256, 60_000)
#: Bytes of lines that are compared together: the more pairs, the fewer steps for each. Pairs of a group that is worked on alone.
COMPARED_BYTES, ENOUGH_PAIRS = 8 << 20, 1_000
#: Bytes of lines of candidate pairs that are moved at once, unless this share of the bytes of all lines is more.
MOVED_BYTES, MOVED_SHARE = 128 << 20, 0.5
#: About the bytes of a pair with the byte counts of both lines.
_COUNTED_BYTES = 160
#: 64-bit words of a band of diagonals beyond which pairs are compared one by one.
BAND_WORDS = 8

#: Bytes that belong to words: letters, digits, and all of non-ASCII characters.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_NORMAL = np.where(_WORD, np.arange(256), 32).astype(np.uint8)
_NORMAL[65:91] += 32
_NORMAL[48:58] = 48
_FEATURE = tb.Hasher(9)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text index and number within the text of each line; texts without bytes have none."""
    breaks = np.flatnonzero(data == 10)
    filled = np.flatnonzero(np.diff(offsets))
    starts = np.sort(np.concatenate([offsets[filled], breaks + 1]), kind="stable")
    text = np.repeat(filled, np.diff(np.searchsorted(breaks, offsets))[filled] + 1)
    ends = np.sort(np.concatenate([breaks, offsets[filled + 1]]), kind="stable")
    firsts = np.searchsorted(text, np.arange(len(offsets) - 1))
    return starts, ends, text, np.arange(len(text)) - firsts[text]


def normalised(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all normalised lines, their offsets (n + 1), and words per line."""
    inside = _WORD[data]
    line = np.zeros(len(data) + 1, np.int64)
    line[starts[starts < len(data)]] = 1
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | (line[1:-1] == 1)
    sums = np.concatenate([[0], np.cumsum(opens)])
    words = sums[ends] - sums[starts]
    # a word keeps its bytes; every word but a line's first has one space before it
    before = np.flatnonzero(opens)
    owner = np.searchsorted(starts, before, "right") - 1
    inner = before[1:][owner[1:] == owner[:-1]]
    keep = inside.astype(np.int64)
    keep[inner] = 2
    place = np.concatenate([[0], np.cumsum(keep)])
    out = np.full(place[-1], 32, np.uint8)
    at = np.flatnonzero(inside)
    out[place[at + 1] - 1] = _NORMAL[data[at]]
    return out, np.concatenate([place[starts], place[-1:]]) if len(starts) else np.zeros(1, np.int64), words


def most_edits(length: int, similarity: float) -> int:
    """Edits that two lines at ``similarity`` may be apart if the longer one has ``length`` bytes."""
    return int((1 - similarity) * length + 1e-9)


@cache
def _pieces_of(length: int, similarity: float) -> np.ndarray:
    """(name, start, end) of the pieces of a line of ``length`` bytes, as the shorter and as the longer line of a pair."""
    out = []
    for shorter in range(1, min(length, SHORT) + 1):
        most, longer = most_edits(length, similarity), length - shorter
        widest = max(n for n in range(shorter, 4 * SHORT) if n - shorter <= most_edits(n, similarity))
        pieces = most_edits(widest, similarity) + 1
        if pieces == 1 or longer > most:
            continue
        cuts = [shorter * i // pieces for i in range(pieces + 1)]
        moves = range(-((most - longer) // 2), (most + longer) // 2 + 1)
        for i in range(pieces):
            for move in moves:
                if 0 <= cuts[i] + move and cuts[i + 1] + move <= length:
                    out.append((shorter * 64 + i, cuts[i] + move, cuts[i + 1] + move))
    return np.array(out, np.int64).reshape(-1, 3)


def piece_keys(data: np.ndarray, offsets: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(line, odd key) of every piece of the lines that may have a shorter partner of ``SHORT`` bytes or be it."""
    size = np.diff(offsets)
    lines, names, starts, ends = ([np.zeros(0, np.int64)] for _ in range(4))
    for n in np.unique(size[size <= int(SHORT / similarity + 1e-9)]).tolist():
        at, table = np.flatnonzero(size == n), _pieces_of(n, similarity)
        lines.append(np.repeat(at, len(table)))
        for into, column in ((names, table[:, 0]), (starts, table[:, 1]), (ends, table[:, 2])):
            into.append((column + offsets[at][:, None] * (into is not names)).ravel())
    line, name, start, end = map(np.concatenate, (lines, names, starts, ends))
    return line, (tb.mix(_FEATURE(data, start, end) ^ tb.mix(name.astype(np.uint64))) | np.uint64(1)).view(np.int64)


def letter_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sixteen counts, up to 15, of a line's bytes modulo 16, in one number."""
    line = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    counts = np.minimum(np.bincount(line * 16 + data[offsets[0] : offsets[-1]] % 16, minlength=16 * (len(offsets) - 1)), 15).reshape(-1, 16).astype(np.uint8)
    return _packed(counts)


def _packed(nibbles: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(nibbles[:, ::2] | nibbles[:, 1::2] << 4).view(np.int64).ravel()


def sketches(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``COORDS`` bytes per line of ``GRAM`` bytes or more: the smallest hash of the runs that fall to each coordinate.

    A coordinate without runs takes another's value, in an order that is the same for all lines.
    """
    n = np.diff(offsets) - GRAM + 1
    owner = np.repeat(np.arange(len(n)), n)
    starts = np.arange(len(owner)) + np.repeat(offsets[:-1] - np.cumsum(n) + n, n)
    hashed = _FEATURE(data, starts, starts + GRAM)
    full, empty = np.full(len(n) * COORDS, 0xFFFFFFFF, np.uint32), np.uint32(0xFFFFFFFF)
    np.minimum.at(full, owner * COORDS + (hashed >> np.uint64(59)).astype(np.int64), np.minimum(hashed & np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFE)).astype(np.uint32))
    full = full.reshape(-1, COORDS)
    first, (row, column), turn = full.copy(), np.nonzero(full == empty), 0
    while len(row):
        other = (column + turn) % COORDS if turn > 64 else (tb.mix(column * 1000 + turn) % np.uint64(COORDS)).astype(np.int64)
        full[row, column] = first[row, other]
        left = full[row, column] == empty
        row, column, turn = row[left], column[left], turn + 1
    return (tb.mix(full) & np.uint64(0xFF)).astype(np.uint8)


def _lines(min_words: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tb.Hasher(5), tb.Hasher(6)
        for batch in batches:
            for part in tb.steps(batch, "text", STEP_BYTES):
                data, offsets = tb.utf8(part.column("text"))
                starts, ends, text, number = line_spans(data, offsets)
                plain, cuts, words = normalised(data, starts, ends)
                some = np.flatnonzero(words >= max(min_words, 1))
                h1, h2 = first(plain, cuts[some], cuts[some + 1]), second(plain, cuts[some], cuts[some + 1])
                size = np.diff(cuts)[some]
                kept = np.flatnonzero(size > SHORT)
                sketch = np.zeros((len(some), COORDS // 8), np.int64)
                if len(kept):
                    at = some[kept]
                    span = np.repeat(cuts[at] - np.cumsum(size[kept]) + size[kept], size[kept]) + np.arange(size[kept].sum())
                    sketch[kept] = sketches(plain[span], np.concatenate([[0], np.cumsum(size[kept])])).view(np.int64)
                line, keys = piece_keys(plain, cuts, similarity)
                order = np.argsort(line, kind="stable")
                begins = np.searchsorted(line[order], np.arange(len(cuts)))
                counts = letter_counts(plain, cuts)[some]
                pieces = [keys[order[begins[i] : begins[i + 1]]] for i in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(text[some])), pa.array(number[some].astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                        pa.array(size.astype(np.int32)), *(pa.array(np.ascontiguousarray(x)) for x in sketch.T), pa.array(counts),
                        pa.ListArray.from_arrays(np.cumsum([0, *map(len, pieces)]).astype(np.int32), pa.array(np.concatenate([np.zeros(0, np.int64), *pieces]))),
                    ],
                    ["doc_id", "line", "node", "check", "size", *_SKETCH, "counts", "pieces"],
                )

    return run


_SKETCH = [f"s{i}" for i in range(COORDS // 8)]
_COUNTS = [f"c{i}" for i in range(4)]


#: What is sent of a line under one triple; ``size`` is 0 where lines of several sizes share the entry.
_ENTRY = np.dtype([("node", "<i8"), ("sketch", "u1", COORDS), ("step", "<i2"), ("size", "<i4"), ("triple", "u1")])
#: The part of the entry at a place, where it isn't the node itself.
_PART = np.dtype([("place", "<i4"), ("part", "<i8")])


def _band_keys(sketch: np.ndarray, step: np.ndarray, triple: int) -> np.ndarray:
    """Even keys of lines under one triple."""
    key = tb.mix(((step + triple % 2) // 2).astype(np.uint64) << np.uint64(8) | np.uint64(triple))
    for c in TRIPLES[triple]:
        key = tb.mix(key ^ sketch[:, c])
    return key & ~np.uint64(1)


def _banded(picked: range, buckets: int):
    """Of rows (node, sketch, step, and size and part or neither) the entries under some triples, packed by bucket of their keys.

    Spark moves and sorts a few packed rows instead of one for each line and triple.
    """

    def packed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        node, sketch, step, size, part = map(np.concatenate, zip(*held))
        bucket = np.concatenate([(_band_keys(sketch, step, i) >> np.uint64(33)) % np.uint64(buckets) for i in picked]).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        row = order % len(node)
        entries = np.empty(len(order), _ENTRY)
        for name, values in (("node", node), ("sketch", sketch), ("step", step), ("size", size)):
            entries[name] = values[row]
        entries["triple"] = np.array(picked)[order // len(node)]
        other = np.flatnonzero(part[row] != node[row])
        parts = np.empty(len(other), _PART)
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        parts["place"], parts["part"] = other - bounds[bucket[order[other]]], part[row[other]]
        cuts, names = np.searchsorted(other, bounds), np.flatnonzero(np.diff(bounds))
        out = [
            (bounds[i + 1] - bounds[i]).astype("<i8").tobytes() + entries[bounds[i] : bounds[i + 1]].tobytes() + parts[cuts[i] : cuts[i + 1]].tobytes()
            for i in names
        ]
        return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(out, pa.binary())], ["bucket", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            of = lambda c: batch.column(c).to_numpy() if c in batch.schema.names else None  # noqa: E731, B023
            node, sketch = of("node"), np.stack([of(c) for c in _SKETCH], axis=1).view(np.uint8).reshape(-1, COORDS)
            held.append((node, sketch, of("step"), np.zeros(len(node), np.int32) if of("size") is None else of("size"), node if of("part") is None else of("part")))
            rows += len(node)
            if rows * len(picked) * _ENTRY.itemsize > HELD_BYTES:
                yield packed(held)
                held, rows = [], 0
        if held:
            yield packed(held)

    return run


def _unpacked(packed: list[bytes]) -> tuple[np.ndarray, ...]:
    """Key, sketch, node, part and size of the entries of a bucket whose key isn't theirs alone, sorted by key."""
    entries, parts = [], []
    for x in packed:
        n = int(np.frombuffer(x, "<i8", 1)[0])
        entries.append(np.frombuffer(x, _ENTRY, n, 8))
        own = entries[-1]["node"].copy()
        other = np.frombuffer(x, _PART, offset=8 + n * _ENTRY.itemsize)
        own[other["place"]] = other["part"]
        parts.append(own)
    rows, part = np.concatenate(entries), np.concatenate(parts)
    key = np.empty(len(rows), np.uint64)
    for i in np.unique(rows["triple"]).tolist():
        at = np.flatnonzero(rows["triple"] == i)
        key[at] = _band_keys(rows["sketch"][at], rows["step"][at].astype(np.int64), i)
    order = np.argsort(key)
    key = key[order]
    like = np.concatenate([[False], key[1:] == key[:-1], [False]])
    some = np.flatnonzero(like[1:] | like[:-1])
    # in the order of nodes, so that groups under several keys are spanned by the same edges
    some = some[np.lexsort((rows["node"][order[some]], key[some]))]
    at = order[some]
    sketch = np.ascontiguousarray(rows["sketch"][at]).view(np.int64).reshape(-1, len(_SKETCH))
    return key[some].view(np.int64), sketch, rows["node"][at], part[at], rows["size"][at]


def _bucket_pairs(similarity: float, parted: bool):
    """Of packed entries sorted by bucket: the edges of :func:`_edges`, or of different parts those of :func:`_parted_edges` whose sizes allow the similarity."""

    def pairs(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        key, sketch, node, part, size = _unpacked(packed)
        if parted:
            yield from _parted_edges(key, sketch, node, part, size=size, similarity=similarity)
        else:
            yield _edges(key, sketch, node)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("entries").to_pylist()):
                if bucket != last and held:
                    yield from pairs(held)
                    held = []
                held.append(packed)
                last = bucket
        if held:
            yield from pairs(held)

    return run


def _close_pairs(apart: int):
    """Of rows (key, sketch or counts, node) sorted by key: edges that span each key's groups of close lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros((0, len(_SKETCH)), np.int64), np.zeros(0, np.int64)]
        for batch in batches:
            now = [batch.column("key").to_numpy(), np.stack([batch.column(c).to_numpy() for c in _SKETCH], axis=1), batch.column("node").to_numpy()]
            if not len(now[0]):
                continue
            rows = [np.concatenate(x) for x in zip(held, now)]
            whole = int(np.searchsorted(rows[0], rows[0][-1]))  # the last key may go on
            held = [x[whole:] for x in rows]
            yield _edges(*(x[:whole] for x in rows), apart=apart)
        yield _edges(*held, apart=apart)

    return run


def _parted_pairs(apart: int):
    """Of rows (key, sketch or counts, node, part) sorted by key: all pairs of close lines of one key in different parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros((0, len(_SKETCH)), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for batch in batches:
            now = [batch.column("key").to_numpy(), np.stack([batch.column(c).to_numpy() for c in _SKETCH], axis=1)]
            now += [batch.column("node").to_numpy(), batch.column("part").to_numpy()]
            if not len(now[0]):
                continue
            rows = [np.concatenate(x) for x in zip(held, now)]
            whole = int(np.searchsorted(rows[0], rows[0][-1]))  # the last key may go on
            held = [x[whole:] for x in rows]
            yield from _parted_edges(*(x[:whole] for x in rows), apart=apart)
        yield from _parted_edges(*held, apart=apart)

    return run


def _parted_edges(
    key: np.ndarray, sketch: np.ndarray, node: np.ndarray, part: np.ndarray, wide: int = 32, apart: int = 8, most: int = 1 << 16,
    size: np.ndarray | None = None, similarity: float = 0.0,
) -> Iterator[pa.RecordBatch]:
    if size is None:
        size, similarity = np.zeros(len(key), np.int64), 0.0
    length = size.astype(np.int64)

    def may(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.abs(length[a] - length[b]) <= ((1 - similarity) * np.maximum(length[a], length[b]) + 1e-9).astype(np.int64)

    bounds = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]) if len(key) else np.zeros(1, np.int64)
    size = np.repeat(np.diff(bounds), np.diff(bounds))
    pairs, held = [], 0
    narrow = np.flatnonzero((size > 1) & (size <= wide))
    for lag in range(1, wide):
        narrow = narrow[narrow + lag < len(key)]
        narrow = narrow[key[narrow] == key[narrow + lag]]
        if not len(narrow):
            break
        open_ = narrow[(part[narrow] != part[narrow + lag]) & may(narrow, narrow + lag)]
        if not len(open_):
            continue
        hit = open_[_near(key[open_], sketch[open_], sketch[open_ + lag], apart)]
        pairs.append((node[hit], node[hit + lag]))
    for first, last in zip(bounds[:-1], bounds[1:]):
        if last - first <= wide or (part[first:last] == part[first]).all():
            continue
        # the members of the largest part come last: they have no partner among themselves
        parts, inverse, counts = np.unique(part[first:last], return_inverse=True, return_counts=True)
        order = first + np.argsort(counts[inverse], kind="stable")
        for i in range(last - first - int(counts.max())):
            rest = order[i + 1 :]
            rest = rest[(part[rest] != part[order[i]]) & may(rest, order[i])]
            if not len(rest):
                continue
            hit = rest[_near(key[order[i]], sketch[rest], sketch[order[i] : order[i] + 1], apart)]
            pairs.append((np.full(len(hit), node[order[i]]), node[hit]))
            held += len(hit)
            if held > most:
                yield _pair_batch(pairs)
                pairs, held = [], 0
    yield _pair_batch(pairs)


def _pair_batch(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _near(key: np.ndarray, a: np.ndarray, b: np.ndarray, apart: int) -> np.ndarray:
    """Odd keys: letter counts at most ``apart`` from each other. Even keys: ``AGREE`` like coordinates."""
    a, b = a.reshape(len(a), -1), b.reshape(-1, a[:1].size)
    out = (a.view(np.uint8) == b.view(np.uint8)).sum(axis=1) >= AGREE
    odd = np.flatnonzero(np.broadcast_to(key & 1, out.shape))
    if len(odd):
        a, b = (np.broadcast_to(x[:, 0], out.shape)[odd] for x in (a, b))
        out[odd] = sum(np.abs((a >> shift & 15) - (b >> shift & 15)) for shift in range(0, 64, 4)) <= apart
    return out


def _edges(key: np.ndarray, sim: np.ndarray, node: np.ndarray, wide: int = 32, apart: int = 8) -> pa.RecordBatch:
    a, b = [], []
    bounds = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]) if len(key) else np.zeros(1, np.int64)
    size = np.repeat(np.diff(bounds), np.diff(bounds))
    narrow = np.flatnonzero((size > 1) & (size <= wide))
    for lag in range(1, wide):
        narrow = narrow[narrow + lag < len(key)]
        narrow = narrow[key[narrow] == key[narrow + lag]]
        if not len(narrow):
            break
        hit = narrow[_near(key[narrow], sim[narrow], sim[narrow + lag], apart)]
        a.append(node[hit])
        b.append(node[hit + lag])
    for first, last in zip(bounds[:-1], bounds[1:]):
        if last - first > wide:
            rest = np.arange(first, last)
            while len(rest):
                front, rest = [rest[0]], rest[1:]
                while front and len(rest):
                    here = front.pop()
                    hit = _near(key[here], sim[rest], sim[here : here + 1], apart)
                    a.append(np.full(hit.sum(), node[here]))
                    b.append(node[rest[hit]])
                    front.extend(rest[hit])
                    rest = rest[~hit]
    join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
    return pa.RecordBatch.from_arrays([join(a), join(b)], ["a", "b"])


def edit_distance(a: bytes, b: bytes) -> int:
    """Levenshtein distance by bit-parallel columns, after common ends are cut off."""
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    n = 0
    while n < min(len(a), len(b)) and a[-1 - n] == b[-1 - n]:
        n += 1
    a, b = a[: len(a) - n], b[: len(b) - n]
    if not a or not b:
        return len(a) + len(b)
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    plus, minus, distance = full, 0, len(a)
    for x in b:
        equal = places.get(x, 0)
        vertical = equal | minus
        equal = ((equal & plus) + plus ^ plus) | equal
        up = minus | ~(equal | plus) & full
        down = plus & equal
        distance += bool(up & last) - bool(down & last)
        up = (up << 1 | 1) & full
        plus = (down << 1 | ~(vertical | up)) & full
        minus = up & vertical
    return distance


def _common(a: bytes, i: int, b: bytes, j: int) -> int:
    """How many bytes from ``i`` and ``j`` on are the same."""
    n, most, step = 0, min(len(a) - i, len(b) - j), 32
    while n < most:
        size = min(step, most - n)
        if a[i + n : i + n + size] == b[j + n : j + n + size]:
            n, step = n + size, 2 * step
        elif size == 1:
            break
        else:
            step = max(1, size // 4)
    return n


def within(a: bytes, b: bytes, most: int, few: int = 12) -> bool:
    """Whether the Levenshtein distance is at most ``most``.

    Up to ``few`` edits are looked for along diagonals, which costs little in the longest lines.
    """
    goal = len(b) - len(a)
    if abs(goal) > most:
        return False
    reached = {0: _common(a, 0, b, 0)}
    for edits in range(min(few, most) + 1):
        if edits:
            before, reached = reached, {}
            for k in range(-edits, edits + 1):
                i = max(before.get(k, -2) + 1, before.get(k - 1, -2), before.get(k + 1, -2) + 1)
                i = min(i, len(a), len(b) - k)
                if i >= max(0, -k):
                    reached[k] = i + _common(a, i, b, i + k)
        if reached.get(goal, -1) >= len(a):
            return True
    return most > few and edit_distance(a, b) <= most


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8), offsets


def _laid(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, lead: np.ndarray, width: int, fill: int) -> np.ndarray:
    """One row per span of ``data``, which begins at place ``lead`` of it."""
    out = np.full((len(starts), width), fill, np.uint8)
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(starts)), sizes), step + np.repeat(lead, sizes)] = data[step + np.repeat(starts, sizes)]
    return out


def _within_band(data: np.ndarray, long: np.ndarray, n_long: np.ndarray, short: np.ndarray, n_short: np.ndarray, most: np.ndarray, words: int) -> np.ndarray:
    """Whether pairs of spans are at most ``most`` edits apart, column by column of all pairs at once.

    Bit-parallel columns of the band of ``most`` diagonals on both sides (Hyyrö), which has ``words`` 64-bit words. The
    distance goes down the band's last diagonal, where it never falls, and then along the longer line's last byte.
    """
    band, one, last = 64 * words, np.uint64(1), np.uint64(63)
    steps, turn = int(n_short.max()), n_long - most
    first = _laid(data, long, n_long, band - 1 - most, band + max(steps, int((n_long + band - most).max())), 0)
    second = np.ascontiguousarray(_laid(data, short, n_short, np.zeros_like(short), steps, 1).T)
    bits = np.arange(band) >= (band - 1 - most)[:, None]
    plus = np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little").view(np.uint64).T)
    minus = np.zeros_like(plus)
    distance, limit, out, at = most.copy(), 2 * most + n_short - n_long, np.zeros(len(long), bool), np.arange(len(long))
    for i in range(steps):
        equal = np.packbits(first[:, i : i + band] == second[i][:, None], axis=1, bitorder="little").view(np.uint64).T
        down, carry = np.empty_like(plus), np.zeros(len(at), bool)
        for w in range(words):
            x = equal[w] & plus[w]
            total = x + plus[w]
            over = total < x
            if words > 1:
                total += carry
                over |= carry & (total == 0)
            carry = over
            down[w] = (total ^ plus[w]) | equal[w] | minus[w]
        right, left = minus | ~(down | plus), down & plus
        along = i >= turn
        if along.any():
            place = np.clip(band - 2 - (i - turn), 0, band - 1)
            word, bit, pair = place >> 6, (place & 63).astype(np.uint64), np.arange(len(at))
            change = (right[word, pair] >> bit & one).astype(np.int64) - (left[word, pair] >> bit & one).astype(np.int64)
            distance += np.where(along, np.where(i < n_short, change, 0), down[-1] >> last == 0)
        else:
            distance += down[-1] >> last == 0
        down >>= one if words == 1 else np.uint64(0)
        if words > 1:
            down = np.concatenate([down[:-1] >> one | down[1:] << last, down[-1:] >> one])
        plus, minus = left | ~(down | right), down & right
        if i % 16 == 15 and i + 1 < steps:
            done = i + 1 >= n_short
            out[at[done]] = distance[done] <= most[done]
            open_ = ~done & (distance <= limit)
            if open_.sum() < 0.8 * len(at):
                at, distance, limit, most, turn, n_short = (x[open_] for x in (at, distance, limit, most, turn, n_short))
                plus, minus, second, first = plus[:, open_], minus[:, open_], second[:, open_], first[open_]
                if not len(at):
                    return out
    out[at] = distance <= most
    return out


def within_all(x: pa.Array, y: pa.Array, most: np.ndarray, cells: int = 1 << 18) -> np.ndarray:
    """:func:`within` for each pair of two binary columns; pairs of like length are worked on together, ``cells`` band bits at once."""
    (a, a_at), (b, b_at) = _bytes_of(x), _bytes_of(y)
    data, most = np.concatenate([a, b]), np.asarray(most, np.int64)
    starts, sizes = np.stack([a_at[:-1], b_at[:-1] + len(a)]), np.stack([np.diff(a_at), np.diff(b_at)])
    longer, pair = (sizes[1] > sizes[0]).astype(np.int64), np.arange(len(most))
    long, n_long, short, n_short = starts[longer, pair], sizes[longer, pair], starts[1 - longer, pair], sizes[1 - longer, pair]
    out, words = np.zeros(len(most), bool), (2 * most + 64) // 64
    near = n_long - n_short <= most
    # a line that could lose all its bytes, lines of very many edits, and bytes that fill up lines here
    alone = near & ((words > BAND_WORDS) | (most >= n_long)) if not len(data) or data.min() > 1 else near
    for i in np.flatnonzero(alone).tolist():
        out[i] = within(x[i].as_py(), y[i].as_py(), int(most[i]))
    rows, counts = np.zeros(0, np.int64), np.unique(words[near & ~alone]).tolist()
    for count in counts:
        # a wider band does for fewer words too
        rows = np.concatenate([rows, np.flatnonzero(near & ~alone & (words == count))])
        if len(rows) < ENOUGH_PAIRS and count != counts[-1]:
            continue
        rows = rows[np.argsort(n_long[rows], kind="stable")]
        for k in range(0, len(rows), max(1, cells // (64 * count))):
            at = rows[k : k + max(1, cells // (64 * count))]
            out[at] = _within_band(data, long[at], n_long[at], short[at], n_short[at], most[at], count)
        rows = rows[:0]
    return out


def byte_counts(line: np.ndarray) -> bytes:
    """How often the bytes of each remainder modulo 32 occur, up to 255."""
    return counts_of_lines(line, np.array([0, len(line)])).tobytes()


def counts_of_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """:func:`byte_counts` of all lines, one row each."""
    line = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return np.minimum(np.bincount(line * 32 + data % 32, minlength=32 * (len(offsets) - 1)), 255).astype(np.uint8).reshape(-1, 32)


def fewest_edits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edits that lines with these byte counts (rows) need at least: one adds at most one byte and takes at most one away."""
    more = a.astype(np.int16) - b
    return np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))


def _may_be_alike(similarity: float):
    """Of rows (a, b, sizes and byte counts of both lines) those whose counts allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = lambda side: np.stack([batch.column(f"{side}_{c}").to_numpy() for c in _COUNTS], axis=1).view(np.uint8)
            longer = np.maximum(batch.column("a_size").to_numpy(), batch.column("b_size").to_numpy())
            kept = fewest_edits(of("a"), of("b")) <= ((1 - similarity) * longer + 1e-9).astype(np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    return run


def _alike(similarity: float):
    """Of rows (a, b, x, y) those whose lines x and y have the similarity."""

    def compared(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pa.Table.from_batches(held).combine_chunks().to_batches():
            for part in tb.steps(batch, "x", COMPARED_BYTES):
                x, y = part.column("x"), part.column("y")
                longer = np.maximum(*(pc.binary_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (x, y)))
                kept = within_all(x, y, ((1 - similarity) * longer + 1e-9).astype(np.int64))
                yield part.select(["a", "b"]).filter(pa.array(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("x").nbytes
            if size >= COMPARED_BYTES:
                yield from compared(held)
                held, size = [], 0
        if held:
            yield from compared(held)

    return run


def _wanted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payload, the normalised line, with its size and byte counts, of the lines that ``wanted`` names, if the text still has them."""
    first = tb.Hasher(5)
    for batch in batches:
        for part in tb.steps(batch, "text", STEP_BYTES):
            data, offsets = tb.utf8(part.column("text"))
            starts, ends, text, number = line_spans(data, offsets)
            plain, cuts, _ = normalised(data, starts, ends)
            begins = np.searchsorted(text, np.arange(part.num_rows + 1))
            wanted = part.column("wanted")
            row, named = np.repeat(np.arange(part.num_rows), pc.list_value_length(wanted).to_numpy(zero_copy_only=False)), wanted.flatten()
            line, node = (named.field(c).to_numpy(zero_copy_only=False) for c in ("line", "node"))
            at = begins[row] + line
            inside = at < begins[row + 1]
            at, node = at[inside], node[inside]
            same = first(plain, cuts[at], cuts[at + 1]).view(np.int64) == node
            at, node = at[same], node[same]
            size = cuts[at + 1] - cuts[at]
            places = np.concatenate([[0], np.cumsum(size)])
            lines = plain[np.repeat(cuts[at] - places[:-1], size) + np.arange(places[-1])]
            packed = counts_of_lines(lines, places).view(np.int64)
            payload = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(lines)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), payload.cast(pa.binary()), pa.array(size, pa.int32()), *(pa.array(np.ascontiguousarray(x)) for x in packed.T)],
                ["node", "payload", "size", *_COUNTS],
            )


def repeated_lines(docs: DataFrame, similarity: float = 0.9, min_words: int = 3) -> DataFrame:
    """(doc_id, removed array<int>): numbers, from 0, of the lines that go; documents that lose none are absent."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL")
    longs = ", ".join(f"{c} long" for c in _SKETCH)
    schema = f"doc_id long, line int, node long, check long, size int, {longs}, counts long, pieces array<long>"
    found = scratch.store(texts.mapInArrow(tb.freeing(_lines(min_words, similarity)), schema))
    lines = found.select("doc_id", "line", "node", "check")
    place = F.struct("doc_id", "line")
    classes = scratch.store(found.groupBy("node", "check").agg(F.min(place).alias("first"), *(F.first(c).alias(c) for c in ("size", *_SKETCH, "counts", "pieces"))))
    # two lines of a pair are one step apart at most, and every other triple joins the steps in the other way
    step = F.floor(F.log("size") / F.lit(1e-6 - math.log(similarity))).cast("long").alias("step")
    long = classes.filter(F.col("size") > SHORT).select("node", *_SKETCH, step, "size")
    n_classes, n_bytes = classes.agg(F.count("*"), F.coalesce(F.sum(F.col("size").cast("long")), F.lit(0))).first()
    most_buckets = -(-n_classes * AT_ONCE * _ENTRY.itemsize // BUCKET_BYTES)
    buckets = min(max(BUCKETS[0], 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), most_buckets), BUCKETS[1])
    alike = scratch.store(long.groupBy(*_SKETCH, "step").agg(F.min("node").alias("leader"), F.count("*").alias("n")))
    same = long.drop("size").join(alike.filter("n > 1"), [*_SKETCH, "step"]).filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    apart = 2 * most_edits(int(SHORT / similarity + 1e-9), similarity)

    leaders = alike.select(*_SKETCH, "step", F.col("leader").alias("node"))
    pieces = classes.select(F.explode("pieces").alias("key"), F.col("counts").alias(_SKETCH[0]), *(F.lit(0).cast("long").alias(c) for c in _SKETCH[1:]), "node")

    def found_by(rows: DataFrame, pairs, key: str = "key", batch: str = SPARK_BATCH_ROWS) -> DataFrame:
        with narrow_batches(spark, batch):
            out = scratch.store(rows.repartition(key).sortWithinPartitions(key).mapInArrow(tb.freeing(pairs), "a long, b long").distinct())
        freed(spark)
        return out

    def found_in_bands(rows: DataFrame, first: int, parted: bool) -> DataFrame:
        """Close lines under some triples. Packed entries reach Python in small batches."""
        packed = rows.mapInArrow(tb.freeing(_banded(range(first, first + AT_ONCE), buckets)), "bucket int, entries binary")
        return found_by(packed, _bucket_pairs(similarity, parted), "bucket", PACKED_BATCH_ROWS)

    def payload_of(nodes: DataFrame) -> DataFrame:
        at = nodes.join(classes, "node").select("first.doc_id", F.struct(F.col("first.line").alias("line"), "node").alias("w"))
        wanted = small(scratch.store(at.groupBy("doc_id").agg(F.collect_list("w").alias("wanted"))))
        schema = "node long, payload binary, size int, " + ", ".join(f"{c} long" for c in _COUNTS)
        wanted = texts.join(wanted, "doc_id").select("text", "wanted").mapInArrow(tb.freeing(_wanted_lines), schema)
        return scratch.store(wanted.groupBy("node").agg(F.min(F.struct("payload", "size", *_COUNTS)).alias("_line")).select("node", "_line.*"))

    def in_turns(pairs: DataFrame, sides: list[DataFrame], each: float, work) -> list[DataFrame]:
        """Pairs (a, b) of ``each`` bytes that pass ``work`` with what ``sides`` know of a and b, joined
        in turns: what is on disk at once follows the input and not the number of pairs."""
        turns = max(1, math.ceil(each * pairs.count() / max(MOVED_BYTES, MOVED_SHARE * n_bytes)))
        out = []
        for turn in range(turns):
            now = lambda df: df.filter(F.pmod(F.xxhash64("a"), F.lit(turns)) == turn) if turns > 1 else df  # noqa: E731, B023
            both = now(pairs).join(now(sides[0]), "a").join(sides[1], "b")
            with narrow_batches(spark):
                out.append(scratch.store(both.mapInArrow(tb.freeing(work), "a long, b long")))
            del both
            freed(spark)
        return out

    def united(frames: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, frames)

    def links_of(pairs: DataFrame) -> list[DataFrame]:
        """Of candidate pairs (a, b) those with the wanted edit similarity."""
        payload = payload_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        sides = [payload.select(F.col("node").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("size", *_COUNTS))) for x in "ab"]
        lines = [payload.select(F.col("node").alias(x), F.col("payload").alias(y)) for x, y in ("ax", "by")]
        mean = payload.agg(F.coalesce(F.avg("size"), F.lit(0.0))).first()[0]
        # most candidates are told apart by their byte counts; only the others are moved with their lines
        near = in_turns(pairs, sides, _COUNTED_BYTES, _may_be_alike(similarity))
        out = in_turns(united(near), lines, 2 * mean, _alike(similarity))
        scratch.drop(payload, *near)
        return out

    # first edges that span the groups of like lines of a few keys: they join nearly all copies
    spanning = [same, found_by(pieces, _close_pairs(apart)), found_in_bands(leaders, 0, False)]
    pairs = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    tried = scratch.store(united(spanning).select(*pairs).distinct())
    links = links_of(tried)
    joined = components(scratch, united(links))

    # then every pair of like lines that is not joined yet, under all keys
    def parted(rows: DataFrame) -> DataFrame:
        return rows.join(joined, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root")

    apart_long = scratch.store(parted(long))
    left = [found_by(parted(pieces), _parted_pairs(apart))]
    left += [found_in_bands(apart_long, i, True) for i in range(0, len(TRIPLES), AT_ONCE)]
    rest = scratch.store(united(left).distinct().join(tried, ["a", "b"], "left_anti"))
    scratch.drop(alike, apart_long, *spanning[1:], *left)
    links += links_of(rest)
    roots = components(scratch, united(links))
    grouped = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = scratch.store(grouped.groupBy("root").agg(F.min("first").alias("kept")).select("root", "kept"))
    named = grouped.select("node", "check", "root").join(kept, "root").select("node", "check", "kept")
    gone = lines.join(named, ["node", "check"]).filter(place != F.col("kept"))
    out = scratch.store(gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("removed")))
    scratch.drop(found, classes, kept, tried, rest, *links, joined)
    return out


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with the named lines taken out of ``text``, and the number of removed lines as ``n_removed``."""
    gone = removed.select(F.col("doc_id").alias("__doc"), F.col("removed").alias("__gone"))
    rows, entries = removed.agg(F.count("*"), F.coalesce(F.sum(F.size("removed")), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and entries <= 8 * BROADCAST_ROWS:  # some tens of MB; a larger table is joined by a shuffle
        gone = F.broadcast(gone)
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("__gone", i)), "\n")
    joined = docs.join(gone, F.col("doc_id") == F.col("__doc"), "left")
    return joined.withColumns(
        {"text": F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept), "__n_removed": F.coalesce(F.size("__gone"), F.lit(0)).cast("long")}
    ).drop("__doc", "__gone")
