"""Repeated word windows, found by recompression.

Rounds name runs of equal symbols and pairs of adjacent ones, beginning with words: in a
pair round a symbol belongs to one of two classes by a bit of its name, and every pair
(first class, second class) becomes one symbol. Names are 64-bit hashes, so all tasks
give the same name to the same symbol without talking to each other, and a cut between
symbols goes or stays by the two symbols beside it alone. For every cut that is left the
outermost words it depends on are known; a symbol together with the words on which its
two cuts depend is an anchor, and it is the same in every text that has those words.

Every window of ``width`` words takes the anchor with the smallest hash among those
inside it, which all its occurrences agree on; a window without any (near long runs)
stands for itself. Anchors that occur twice anywhere, found by a shuffle of their hashes,
give candidate windows; these are compared by 128-bit hashes of their words in a second
shuffle, and each that starts earlier elsewhere covers its words. Tasks combine before
both shuffles: each sends a hash once, whatever its number of occurrences, and settles
repeats inside the task by itself.

Defined results: null, empty and blank texts have no words and lose none; a text shorter
than a window loses none; rows that share a ``doc_id`` count as one document, equal
places in them as one; rows with a null ``doc_id`` take no part. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.clusters import runs
from riskloom.llm.tables import BROADCAST_ROWS, Scratch

PAIR_ROUNDS = 3
_FAR = np.int64(1) << 40
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_K = tb.seeds(4, 61) | np.uint64(1)


class Words:
    """Word hashes of a column of texts, and hashes of word ranges."""

    def __init__(self, column: pa.Array) -> None:
        self.data, offsets = tb.utf8(column)
        self.starts, self.ends, self.firsts = tb.spans(self.data, offsets, tb.SPACES)
        self.names = _NAME(self.data, self.starts, self.ends)
        self.other = _OTHER(self.data, self.starts, self.ends)

    def windows(self, width: int) -> np.ndarray:
        """Places where a whole window of one text starts."""
        end = np.repeat(self.firsts[1:], np.diff(self.firsts))
        return np.flatnonzero(np.arange(len(self.names)) + width <= end)

    def ranges(self, low: np.ndarray, high: np.ndarray, other: bool = False) -> np.ndarray:
        return (_SUM_OTHER if other else _SUM)(self.other if other else self.names, low, high)


class _RangeSum:
    """Hash of word ranges by prefix sums of name * m^place, moved to place 0."""

    def __init__(self, multiplier: int) -> None:
        self.powers = tb.Powers(multiplier)

    def __call__(self, names: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        powers, inverses = self.powers(len(names) + 1)
        sums = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(names * powers[: len(names)], out=sums[1:])
        return tb.mix((sums[high] - sums[low]) * inverses[low] + (high - low).astype(np.uint64) * _K[3])


_NAME, _OTHER = tb.Hasher(62), tb.Hasher(63)
_SUM, _SUM_OTHER = _RangeSum(int(_K[0])), _RangeSum(int(_K[1]))


def recompressed(names: np.ndarray, firsts: np.ndarray, rounds: int = PAIR_ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the last round's symbols, and the outermost words each depends on (far outside at a text's ends)."""
    cut = np.arange(len(names) + 1)
    edge = np.zeros(len(cut), bool)
    edge[firsts] = True
    left = right = cut  # between words there is a cut in any case, at a text's ends too
    symbol = names
    for step in range(rounds + 1):
        if len(symbol) < 2:
            break
        joins = np.zeros(len(cut), bool)
        if step == 0:
            joins[1:-1] = symbol[1:] == symbol[:-1]
        else:
            late = tb.mix(symbol ^ np.uint64(int(_K[2]) * step % (1 << 64))) & np.uint64(1) == 1
            joins[1:-1] = ~late[:-1] & late[1:]
        joins &= ~edge
        first = np.flatnonzero(~joins[:-1])
        size = np.diff(np.append(first, len(symbol)))
        merged = symbol[first]
        if step == 0:
            merged = np.where(size > 1, tb.mix(merged * _K[0] + size.astype(np.uint64)), merged)
        else:
            merged = np.where(size > 1, tb.mix(merged * _K[1] + symbol[np.minimum(first + 1, len(symbol) - 1)] + np.uint64(step)), merged)
        moved_left, moved_right = left.copy(), right.copy()
        moved_left[1:], moved_right[:-1] = left[:-1], right[1:]
        left, right = np.where(edge, -_FAR, moved_left), np.where(edge, _FAR, moved_right)
        keep = ~joins
        cut, left, right, edge, symbol = cut[keep], left[keep], right[keep], edge[keep], merged
    return cut[:-1], cut[1:], left[:-1], right[1:]


def anchors(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first and last window start of each anchor that some window takes, and of windows that stand for themselves."""
    _, _, left, right = recompressed(words.names, words.firsts)
    safe = (left >= 0) & (right <= len(words.names)) & (right - left <= width)
    left, right = left[safe], right[safe]
    text = np.searchsorted(words.firsts, left, "right") - 1
    low = np.maximum(right - width, words.firsts[text])
    high = np.minimum(left, words.firsts[text + 1] - width)
    fits = low <= high
    left, right, low, high = left[fits], right[fits], low[fits], high[fits]
    key = words.ranges(left, right)
    best = np.full(len(words.names), _NONE)
    for d in range(width):
        on = low + d <= high
        if not on.any():
            break
        np.minimum.at(best, low[on] + d, key[on])
    taken = np.zeros(len(key), bool)
    for d in range(width):
        on = np.flatnonzero((low + d <= high) & ~taken)
        taken[on] = best[low[on] + d] == key[on]
    alone = words.windows(width)
    alone = alone[best[alone] == _NONE]
    own = tb.mix(words.ranges(alone, alone + width) ^ _K[2])
    return np.concatenate([key[taken], own]), np.concatenate([low[taken], alone]), np.concatenate([high[taken], alone])


def _packed(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row per bucket with each column's values as bytes."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]]) if len(order) else np.zeros(1, int)
    numbers = bucket[order][cuts[:-1]] if len(order) else np.zeros(0, np.int32)
    fields = [pa.array([c[order[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()) for c in columns]
    yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), *fields], ["bucket", *"abcde"[: len(columns)]])


def _buckets(key: np.ndarray, n: int) -> np.ndarray:
    return ((key >> np.uint64(33)) % np.uint64(n)).astype(np.int32)


def _anchor_rows(width: int, buckets: int):
    """One entry per distinct anchor of the task; those that the task itself has twice are marked as settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            for part in tb.steps(batch, "text"):
                words = Words(part.column("text"))
                key, low, high = anchors(words, width)
                text = np.searchsorted(words.firsts, low, "right") - 1
                doc = part.column("doc_id").to_numpy(zero_copy_only=False)[text].astype(np.int64)
                begin = words.firsts[text]
                held.append([key, doc, (low - begin).astype(np.int32), (high - begin).astype(np.int32)])
                if sum(len(h[0]) for h in held) > 4_000_000:
                    yield from _combined(held, buckets)
                    held = []
        if held:
            yield from _combined(held, buckets)

    return run


def _combined(held: list[list[np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    key, doc, low, high = (np.concatenate(x) for x in zip(*held))
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[which] > 1
    first = np.zeros(len(key), bool)
    first[np.unique(key, return_index=True)[1]] = True
    # bit 0: the task's one entry for this hash; bit 1: settled here, needs no answer
    state = (first * 1 + twice * 2).astype(np.int8)
    yield from _packed(_buckets(key, buckets), [key, doc, low, high, state])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows (doc_id, low, high) of all anchors that occur twice."""
    for rows in runs(batches, "bucket"):
        key, doc, low, high, state = (
            np.frombuffer(b"".join(rows.column(c).to_pylist()), t) for c, t in zip("abcde", (np.uint64, np.int64, np.int32, np.int32, np.int8))
        )
        _, which, count = np.unique(key[state & 1 == 1], return_inverse=True, return_counts=True)
        hit = state >= 2
        hit[np.flatnonzero(state & 1 == 1)[count[which] > 1]] = True
        yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (doc, low, high)], ["doc_id", "low", "high"])


def least_grams(words: Words, width: int, gram: int = 4) -> np.ndarray:
    """For each place the smallest hash of the ``gram``-word runs inside the window there.

    Equal windows have the same, and so have most neighbours, which keeps a repeat together.
    """
    gram = min(gram, width)
    place = np.arange(len(words.names))
    least = words.ranges(place, np.minimum(place + gram, len(place)))
    span, done = width - gram + 1, 1
    while done < span:
        step = min(done, span - done)
        least[: len(least) - step] = np.minimum(least[: len(least) - step], least[step:])
        done += step
    return least


def _window_rows(width: int, buckets: int):
    """Per task the first occurrence of each candidate window; later ones of the task are settled (state 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            for part in tb.steps(batch, "text"):
                words = Words(part.column("text"))
                wanted = np.zeros(len(words.names) + 1, np.int64)
                for row, spots in enumerate(part.column("spots").to_pylist()):
                    base = words.firsts[row]
                    for s in spots:
                        wanted[min(base + s["low"], len(wanted) - 1)] += 1
                        wanted[min(base + s["high"] + 1, len(wanted) - 1)] -= 1
                at = words.windows(width)
                at = at[np.cumsum(wanted)[at] > 0]
                text = np.searchsorted(words.firsts, at, "right") - 1
                doc = part.column("doc_id").to_numpy(zero_copy_only=False)[text].astype(np.int64)
                both = words.ranges(at, at + width), words.ranges(at, at + width, True)
                held.append([*both, doc, (at - words.firsts[text]).astype(np.int32), least_grams(words, width)[at]])
                if sum(len(h[0]) for h in held) > 2_000_000:
                    yield from _first_windows(held, buckets)
                    held = []
        if held:
            yield from _first_windows(held, buckets)

    return run


def _later(a: np.ndarray, b: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """True for rows whose window (a, b) has a row with a smaller (doc, place)."""
    order = np.lexsort((place, doc, b, a))
    same = np.zeros(len(order), bool)
    same[1:] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
    begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    head = order[begin]
    out = np.zeros(len(order), bool)
    out[order] = (doc[order] != doc[head]) | (place[order] != place[head])
    return out


def _first_windows(held: list[list[np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    a, b, doc, place, near = (np.concatenate(x) for x in zip(*held))
    yield from _packed(_buckets(tb.mix(near), buckets), [a, b, doc, place, _later(a, b, doc, place).astype(np.int8)])


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket and document the places of windows that start earlier elsewhere."""
    for rows in runs(batches, "bucket"):
        a, b, doc, place, settled = (
            np.frombuffer(b"".join(rows.column(c).to_pylist()), t) for c, t in zip("abcde", (np.uint64, np.uint64, np.int64, np.int32, np.int8))
        )
        hit = settled == 1
        open_ = np.flatnonzero(~hit)
        hit[open_[_later(a[open_], b[open_], doc[open_], place[open_])]] = True
        doc, place = doc[hit], place[hit]
        order = np.argsort(doc, kind="stable")
        doc, place = doc[order], place[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1, [len(doc)]]) if len(doc) else np.zeros(1, int)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[cuts[:-1]] if len(doc) else doc), pa.array([place[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())], ["doc_id", "places"]
        )


def _spans_of(width: int):
    """(doc_id, list of places) to (doc_id, covered spans of words as pairs of int32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lists in batch.column("lists").to_pylist():
                place = np.unique(np.frombuffer(b"".join(lists), np.int32))
                gap = np.flatnonzero(np.diff(place) > width)
                low, high = np.append(place[:1], place[gap + 1]), np.append(place[gap], place[-1:]) + width
                out.append(np.stack([low, high], axis=1).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "spans"])

    return run


def covered_words(docs: DataFrame, width: int = 20) -> DataFrame:
    """(doc_id, spans binary): per document that loses words the spans [low, high) of its words, as int32 pairs."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "windows")
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL")
    entry = "bucket int, a binary, b binary, c binary, d binary, e binary"
    dealt = texts.mapInArrow(_anchor_rows(width, buckets), entry).repartition("bucket").sortWithinPartitions("bucket")
    spots = dealt.mapInArrow(_repeated, "doc_id long, low int, high int").distinct()
    spots = scratch.store(spots.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("spots")))
    asked = texts.join(_checked(spots, F.size("spots")), "doc_id")
    dealt = asked.mapInArrow(_window_rows(width, buckets), entry).repartition("bucket").sortWithinPartitions("bucket")
    places = dealt.mapInArrow(_covered, "doc_id long, places binary")
    lists = places.groupBy("doc_id").agg(F.collect_list("places").alias("lists"))
    out = scratch.store(lists.mapInArrow(_spans_of(width), "doc_id long, spans binary"))
    scratch.drop(spots)
    return out


def _checked(df: DataFrame, width) -> DataFrame:
    rows, entries = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and entries <= 4 * BROADCAST_ROWS else df


def _kept(texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.steps(batch, "text"):
                data, offsets = tb.utf8(part.column("text"))
                starts, ends, firsts = tb.spans(data, offsets, tb.SPACES)
                raw, removed, kept = data.tobytes(), [], []
                for row, spans in enumerate(part.column("spans").to_pylist()):
                    keep = np.ones(firsts[row + 1] - firsts[row], bool)
                    for low, high in np.frombuffer(spans or b"", np.int32).reshape(-1, 2).tolist():
                        keep[low:high] = False
                    at = firsts[row] + np.flatnonzero(keep)
                    text = b" ".join([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
                    removed.append(int((~keep).sum()))
                    kept.append(text.decode() if texts else hashlib.sha256(text).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(firsts)), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"]
                )

    return run


def without_repeats(docs: DataFrame, width: int = 20, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the words that stay, joined by one space (with ``digest`` its SHA-256)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = covered_words(docs, width)
    joined = texts.join(_checked(spans, F.octet_length("spans") / 8), "doc_id", "left")
    return joined.mapInArrow(_kept(not digest), "doc_id long, n_words long, n_removed long, kept string")
