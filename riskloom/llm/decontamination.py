"""Benchmark items inside long documents: size-partitioned MinHash containment, verified exactly.

An item's set is its distinct five-word shingles (words: runs of letters, digits and
non-ASCII characters, A-Z lower-cased). Items are partitioned by set size into classes
[2^j, 2^(j+1)). For the class with upper bound u a document is seen as windows of 5/4 u
shingles, one every u/4, so an item inside the document is inside one window and their
Jaccard similarity is about 0.3 or more even at containment 0.8 in the class's smallest
item. Window and item are candidates if they agree in one of ``HASHES`` MinHashes (missed
with probability (1 - J)^64, 2e-10 at 0.3). A candidate counts if at least ``share`` of
the item's shingles are in the whole document, compared as words.

Items are the query set. They are taken in blocks of bounded bytes, and each block meets
all documents in its own pass, so its broadcast never grows with the benchmark. Documents
without any shingle of the block, by their hashes, have no candidate and
are passed over; that loses nothing, as equal MinHashes are an equal shingle.

Defined results: null or empty texts and items have no shingles and match nothing; a text
of one to four words is one shingle, so such an item is found only as a whole text;
repeated rows give repeated pairs; a null ``doc_id`` or ``item_id`` is carried as null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.line_dedup import _WORD

HASHES = 64
#: Text bytes of the items that are broadcast at once.
BLOCK_BYTES = 8 << 20
_MULTIPLIERS = tb.seeds(HASHES, 31) | np.uint64(1)
_SHIFTS = tb.seeds(HASHES, 32)
_BITS = 22


def shingle_words(text: bytes, width: int) -> set[bytes]:
    """The distinct shingles of one text, as words joined by single spaces."""
    clean = np.where(_WORD, np.arange(256), 32).astype(np.uint8)
    clean[65:91] += 32
    words = clean[np.frombuffer(text, np.uint8)].tobytes().split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


class ItemIndex:
    """Signatures of one block of items, by size class."""

    def __init__(self, ids: list[int | None], texts: list[str | None], width: int) -> None:
        self.ids, self.width = ids, width
        self.sets = [shingle_words((t or "").encode(), width) for t in texts]
        values, begins = _values(pa.array(texts, pa.string()), width)
        sizes = np.array([len(s) for s in self.sets], np.int64)
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[values >> np.uint64(64 - _BITS)] = True
        self.values = np.unique(values)
        filled = np.flatnonzero(sizes)
        level = np.floor(np.log2(np.maximum(sizes, 1))).astype(int) + 1
        self.classes: list[tuple[int, list[tuple[np.ndarray, np.ndarray]]]] = []
        for j in np.unique(level[filled]):
            rows = filled[level[filled] == j]
            signature = np.stack([_hashed(values[begins[r] : begins[r + 1]]).min(axis=1) for r in rows])
            order = np.argsort(signature, axis=0, kind="stable")
            self.classes.append((1 << int(j), [(signature[order[:, k], k], rows[order[:, k]]) for k in range(HASHES)]))

    def candidates(self, values: np.ndarray) -> set[int]:
        """Items that agree with a window of the document in a MinHash."""
        hits = values[self.bitmap[values >> np.uint64(64 - _BITS)]]
        if not len(hits) or (self.values[np.searchsorted(self.values[:-1], hits)] != hits).all():
            return set()
        found: set[int] = set()
        for bound, tables in self.classes:
            step = max(1, bound // 4)
            starts = np.arange(0, len(values), step)
            for low in range(0, len(starts), 4096):  # of a very long text, a part at a time
                own = starts[low : low + 4100]
                least = np.minimum.reduceat(_hashed(values[own[0] : own[-1] + step]), own - own[0], axis=1)
                window = least.copy()
                for k in range(1, min(5, least.shape[1])):
                    window[:, :-k] = np.minimum(window[:, :-k], least[:, k:])
                for k, (sorted_, rows) in enumerate(tables):
                    a = np.searchsorted(sorted_, window[k], "left")
                    b = np.searchsorted(sorted_, window[k], "right")
                    for x, y in set(zip(a[b > a].tolist(), b[b > a].tolist())):
                        found.update(rows[x:y].tolist())
        return found


def _hashed(values: np.ndarray) -> np.ndarray:
    return tb.mix(values[None, :] * _MULTIPLIERS[:, None] + _SHIFTS[:, None])


def _values(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tb.utf8(column)
    starts, ends, firsts = tb.spans(data, offsets, ~_WORD)
    return tb.shingles(tb.Hasher(8, lower=True)(data, starts, ends), firsts, width)


def _search(index, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: ItemIndex = index.value
        for batch in batches:
            for part in tb.steps(batch, "text"):
                values, begins = _values(part.column("text"), items.width)
                rows, item, shared = [], [], []
                for r in range(part.num_rows):
                    near = items.candidates(values[begins[r] : begins[r + 1]])
                    if near:
                        own = shingle_words(part.column("text")[r].as_py().encode(), items.width)
                        for i in sorted(near):
                            common = len(items.sets[i] & own)
                            if common >= share * len(items.sets[i]) - 1e-9:
                                rows.append(r)
                                item.append(i)
                                shared.append(common)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array([items.ids[i] for i in item], pa.int64()),
                        pa.array([len(items.sets[i]) for i in item], pa.int64()),
                        pa.array(shared, pa.int64()),
                    ],
                    ["doc_id", "item_id", "n_item", "n_shared"],
                )

    return run


def contained_items(docs: DataFrame, items: DataFrame, share: float = 0.8, width: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_item (the item's shingles), n_shared, containment; a row per pair that is found."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + int(total) // block_bytes
    found = None
    for k in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toPandas()
        ids = [None if x is None or x != x else int(x) for x in block["item_id"]]
        index = spark.sparkContext.broadcast(ItemIndex(ids, block["text"].tolist(), width))
        part = texts.mapInArrow(tb.freeing(_search(index, share)), "doc_id long, item_id long, n_item long, n_shared long")
        found = part if found is None else found.unionByName(part)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))
