"""Token ids in fixed-width bit packing, written and read back.

Every id takes the bits that the vocabulary's largest id needs. Documents are dealt to
ranges of doc_id (bounds from a sketch of the ids alone, so texts are encoded once, where
they are read), and a range's documents, in ascending doc_id, fill blocks of about
``BLOCK_IDS`` ids. The file format is a Parquet table with a row per block: number of the
range and the block, id count of the block, bits, packed bytes (little-endian bit order),
and per document its doc_id and its first id's offset in the block. Offsets let a reader
unpack one document alone: :func:`unpack` with ``first`` and ``count`` touches only the
bytes that hold it.

Defined results: null and empty texts have only the end id; rows with equal doc_id follow
each other in the order of their text's hash, rows with a null doc_id come first; repeated
rows are documents of their own; an empty table gives no blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.pieces import Memo, cuts
from riskloom.llm.tables import Scratch, small

BLOCK_IDS = 1 << 18
END = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

BLOCKS = "range int, block int, n_ids long, bits int, packed binary, doc_ids array<long>, rows array<long>, firsts array<long>"


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, the lowest first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(wide.ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` one on, reading only their bytes."""
    low = first * bits // 8
    part = np.frombuffer(packed, np.uint8, min(-(-(first + count) * bits // 8), len(packed)) - low, low) if count else np.zeros(0, np.uint8)
    if bits in (8, 16, 32):
        return part.view(f"<u{bits // 8}").astype(np.uint32)
    flat = np.unpackbits(part, bitorder="little")[first * bits - 8 * low :][: count * bits]
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flat.reshape(count, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def lowered_pieces(column: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """Pieces of all texts without white space, A-Z lower-cased where no special token can be, and the first piece of each text (n + 1).

    For tokenizers that drop white space and lower-case by themselves, which makes more pieces equal.
    """
    data, offsets = tb.utf8(column)
    inside = ~tb.SPACES[data]
    begin = cuts(data) & inside  # at a stop after a letter
    begin[1:] |= inside[1:] & ~inside[:-1]
    begin[offsets[offsets < len(data)]] |= inside[offsets[offsets < len(data)]]
    starts = np.flatnonzero(begin)
    finish = np.zeros(len(data) + 1, bool)
    finish[starts] = True
    finish[1:-1] |= ~inside[1:] & inside[:-1]
    finish[offsets] = True
    stops = np.flatnonzero(finish)
    ends = stops[np.searchsorted(stops, starts, "right")]
    raw, low = data.tobytes(), _LOWER[data].tobytes()
    pieces = [low[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    if b"<|" in raw:
        pieces = [raw[a:b] if b"<|" in p else p for p, a, b in zip(pieces, starts.tolist(), ends.tolist())]
    return pieces, np.searchsorted(starts, offsets)


def _encoded(path: str, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo.of(path, "|")
        for batch in batches:
            for part in tb.steps(batch, "text"):
                pieces, firsts = lowered_pieces(part.column("text"))
                ids, counts = memo.ids(memo.indices(pieces)) if pieces else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
                at = np.concatenate([[0], np.cumsum(counts)])[firsts]
                packed = [pack(np.append(ids[a:b], np.uint32(END)), bits) for a, b in zip(at[:-1], at[1:])]
                columns = [pa.array(np.diff(at) + 1), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), part.column("range"), *columns], ["doc_id", "row", "range", "n_tokens", "packed"])

    return run


def _blocked(bits: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        place, number = None, 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate([unpack(p, bits, 0, n) for _, _, n, p in held])
            firsts = np.cumsum([0, *(n for _, _, n, _ in held)])[:-1].tolist()
            row = [[place], [number], [len(ids)], [bits], [pack(ids, bits)], [[h[0] for h in held]], [[h[1] for h in held]], [firsts]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), *[pa.list_(pa.int64())] * 3]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["range", "block", "n_ids", "bits", "packed", "doc_ids", "rows", "firsts"])

        size = 0
        for batch in batches:
            for doc, row, at, n, packed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "range", "n_tokens", "packed"))):
                if held and (at != place or size >= block_ids):
                    yield block()
                    number = number + 1 if at == place else 0
                    held, size = [], 0
                place = at
                held.append((doc, row, n, packed))
                size += n
        if held:
            yield block()

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document of each block, from the packed bytes: number of ids and their CRC."""
    for batch in batches:
        for b in batch.to_pylist():
            firsts = [*b["firsts"], b["n_ids"]]
            crc = [zlib.crc32(unpack(b["packed"], b["bits"], a, z - a).astype("<u4").tobytes()) for a, z in zip(firsts[:-1], firsts[1:])]
            n = len(crc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b["range"]] * n, pa.int32()), pa.array([b["block"]] * n, pa.int32()), pa.array(b["doc_ids"], pa.int64()),
                    pa.array(b["firsts"], pa.int64()), pa.array(np.diff(firsts)), pa.array(crc, pa.int64()),
                ],
                ["range", "block", "doc_id", "first", "n_tokens", "ids_crc32"],
            )


def write_ids(docs: DataFrame, path: str, out: str, block_ids: int = BLOCK_IDS) -> None:
    """Encodes every text and writes the blocks below ``out``."""
    from riskloom.llm.pieces import load

    spark = docs.sparkSession
    bits = max(1, (max(load(path).get_vocab(with_added_tokens=True).values())).bit_length())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(texts.stat.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges)))
    number = F.lit(0)
    if bounds:  # how many bounds are below the id, by a sorted constant array
        number = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("doc_id")))
    keyed = texts.select("doc_id", "text", F.xxhash64("text").alias("row"), F.greatest(number, F.lit(0)).cast("int").alias("range"))
    coded = keyed.mapInArrow(_encoded(path, bits), "doc_id long, row long, range int, n_tokens long, packed binary")
    dealt = coded.repartition("range").sortWithinPartitions("range", F.asc_nulls_first("doc_id"), "row")
    dealt.mapInArrow(_blocked(bits, block_ids), BLOCKS).write.option("compression", "uncompressed").parquet(out)


def read_ids(spark, out: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files at ``out``."""
    blocks = spark.read.schema(BLOCKS).parquet(out)
    order = Window.partitionBy("range").orderBy("block")
    within = blocks.select("range", "block", "n_ids").withColumn("inside", F.sum("n_ids").over(order) - F.col("n_ids"))
    totals = blocks.groupBy("range").agg(F.sum("n_ids").alias("total"))
    before = totals.withColumn("before", F.sum("total").over(Window.orderBy("range")) - F.col("total"))  # a row per range
    starts = within.join(before, "range").select("range", "block", (F.col("before") + F.col("inside")).alias("base"))
    rows = blocks.mapInArrow(_read, "range int, block int, doc_id long, first long, n_tokens long, ids_crc32 long")
    return rows.join(small(starts), ["range", "block"]).select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def stored_ids(docs: DataFrame, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Writes the ids into the shared folder and reads them back."""
    out = f"{Scratch(docs.sparkSession, 'ids').root}/blocks"
    write_ids(docs, path, out, block_ids)
    return read_ids(docs.sparkSession, out)
