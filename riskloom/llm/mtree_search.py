"""Exact inner-product top-k by best-first search in M-trees.

Vectors become whole numbers, floor(``SCALE`` * x). Equal vectors are one entry with the
rows that a top-k with ties to smaller ids and without the query's own id can need: the
k + 1 smallest ids, each at most k times, so a vector that a third of all rows share is
one entry. Entries are dealt to cells of the nearest pivot (a bounded sample of at most
``PIVOTS`` entries), cells to blocks of at most about ``BLOCK`` entries, and each block
is an M-tree of pages: inner nodes and leaves have a centre (chosen farthest first), a
covering radius and the distance to their parent's centre.

For a query q and a ball (c, r) no entry's product is above q.c + |q| r. A query first
meets one block of the cell with the highest such bound; its k-th best score there is the
floor for all other blocks, and only cells whose bound reaches it are asked. In a block a
node is first judged by its parent's product and the stored distance, q.p + |q| (d(p, c)
+ r), and only if that reaches the k-th best so far is its own product computed. Nodes are
visited best bound first, for many queries of one block together, until the next bound is
below the k-th best; ties are kept. A block is copied once per ``_turn`` queries that
reach it (a bound in bytes), so queries, not the index, make up the shuffle.

Defined results: vectors that are null or hold null or non-finite components, and rows
with a null id, take no part; rows that stand more than once count as candidates as often
as they stand, and once as a query; a query finds no row of its own id, and an id with
several vectors gets the best of all of them; shorter vectors count as filled up with
zeros; queries get all candidates if there are fewer than k. Products must stay below 2^63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.clusters import runs
from riskloom.llm.tables import Scratch

SCALE, PIVOTS, BLOCK, PAGE, FAN, QUERIES = 64, 1024, 8192, 64, 16, 1024
_NONE = np.iinfo(np.int64).max


class Tree:
    """One block: entries in page order, inner nodes, and leaves under them."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]) -> None:
        self.exact = np.abs(vectors).max(initial=0) ** 2 * vectors.shape[1] < 2**53 if vectors.size else True
        x = vectors.astype(np.float64)
        leaves, self.inner = [], []
        for inner in _cells(x, np.arange(len(x)), -(-len(x) // (PAGE * FAN)), PAGE * FAN):
            centre, first = x[inner[0]], len(leaves)
            for leaf in _cells(x, inner, -(-len(inner) // PAGE), PAGE):
                c = x[leaf[0]]
                leaves.append((leaf, c, _far(x[leaf], c), float(np.linalg.norm(c - centre))))
            self.inner.append((centre, _far(x[inner], centre), first, len(leaves)))
        order = np.concatenate([leaf for leaf, *_ in leaves])
        self.x, self.whole, self.ids = x[order], vectors[order], [ids[i] for i in order]
        self.least = np.array([i[0] for i in self.ids], np.int64)
        self.second = np.array([next((j for j in i if j != i[0]), _NONE) for i in self.ids], np.int64)
        self.products = 0  # entries whose product with a query was computed
        self.ends = np.cumsum([0, *(len(leaf) for leaf, *_ in leaves)])
        self.centres = np.stack([c for _, c, _, _ in leaves])
        self.radii = np.array([r for _, _, r, _ in leaves])
        self.to_parent = np.array([d for *_, d in leaves])

    def search(self, queries: np.ndarray, k: int, own: np.ndarray | None = None, floor: np.ndarray | None = None) -> list[list[tuple[int, int]]]:
        """Per query (score, entry) of the k best entries that hold a row of another id than ``own``.

        Ties go to the smallest such id. Entries below ``floor`` may be left out.
        """
        own = np.full(len(queries), -1) if own is None else own
        floor = np.full(len(queries), -np.inf) if floor is None else floor
        q = queries.astype(np.float64)
        norm = np.linalg.norm(q, axis=1)
        slack = 1e-9 * (1 + norm * np.abs(self.x).max(initial=0) * self.x.shape[1])
        score = np.full((len(q), k), -np.inf) if self.exact else np.full((len(q), k), np.iinfo(np.int64).min)
        entry = np.full((len(q), k), -1)
        at_centre = q @ np.stack([c for c, *_ in self.inner]).T
        bound = at_centre + norm[:, None] * np.array([r for _, r, *_ in self.inner]) + slack[:, None]
        order = np.argsort(-bound, axis=1, kind="stable")
        for turn in range(len(self.inner)):
            node = order[:, turn]
            active = np.flatnonzero(bound[np.arange(len(q)), node] >= np.maximum(score[:, -1], floor))
            if not len(active):
                break
            for n in np.unique(node[active]):
                self._leaves(n, active[node[active] == n], q, queries, norm, slack, at_centre[:, n], score, entry, own, floor)
        return [[(int(s), int(e)) for s, e in zip(*row) if e >= 0] for row in zip(score, entry)]

    def _leaves(self, n, rows, q, queries, norm, slack, at_centre, score, entry, own, floor) -> None:
        _, _, first, last = self.inner[n]
        reach = at_centre[rows, None] + norm[rows, None] * (self.to_parent[first:last] + self.radii[first:last]) + slack[rows, None]
        open_ = reach >= np.maximum(score[rows, -1:], floor[rows, None])
        asked = np.flatnonzero(open_.any(axis=0))  # the other leaves' centres need no product
        bound = np.full(open_.shape, -np.inf)
        bound[:, asked] = q[rows] @ self.centres[first + asked].T + norm[rows, None] * self.radii[first + asked] + slack[rows, None]
        bound[~open_] = -np.inf
        for m in asked[np.argsort(-bound[:, asked].max(axis=0), kind="stable")]:  # best bound of the group first
            active = np.flatnonzero((bound[:, m] >= np.maximum(score[rows, -1], floor[rows])) & (bound[:, m] > -np.inf))
            if len(active):
                self._page(first + m, rows[active], q, queries, score, entry, own)

    def _page(self, leaf, rows, q, queries, score, entry, own) -> None:
        a, b = self.ends[leaf], self.ends[leaf + 1]
        found = q[rows] @ self.x[a:b].T if self.exact else queries[rows] @ self.whole[a:b].T
        self.products += found.size
        better = (found >= score[rows, -1:]).any(axis=1)
        rows, found = rows[better], found[better]
        if not len(rows):
            return
        k = score.shape[1]
        scores = np.hstack([score[rows], found])
        entries = np.hstack([entry[rows], np.broadcast_to(np.arange(a, b), found.shape)])
        least = np.where(self.least[entries] == own[rows, None], self.second[entries], self.least[entries])
        entries[least == _NONE] = -1  # rows of the query's own id alone
        scores[entries < 0] = -np.inf if self.exact else np.iinfo(np.int64).min
        least[entries < 0] = _NONE
        keep = np.lexsort((least, -scores if self.exact else ~scores), axis=-1)[:, :k]
        score[rows], entry[rows] = np.take_along_axis(scores, keep, 1), np.take_along_axis(entries, keep, 1)


def _far(x: np.ndarray, centre: np.ndarray) -> float:
    return float(np.sqrt(((x - centre) ** 2).sum(axis=1).max())) * (1 + 1e-12)


def _cells(x: np.ndarray, rows: np.ndarray, n: int, most: int) -> Iterator[np.ndarray]:
    """``rows`` by the nearest of ``n`` of them, each cell in parts of at most ``most``."""
    own = x[rows]
    far, chosen = np.full(len(rows), np.inf), [0]
    for _ in range(n - 1):  # farthest first
        far = np.minimum(far, ((own - own[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(far.argmax()))
    pivots = own[chosen]
    distance = (own**2).sum(axis=1)[:, None] - 2 * own @ pivots.T + (pivots**2).sum(axis=1)
    nearest = distance.argmin(axis=1)
    for p in range(n):
        own = np.flatnonzero(nearest == p)
        own = rows[own[np.argsort(distance[own, p], kind="stable")]]
        for i in range(0, len(own), most):
            yield own[i : i + most]


def _matrix(lists: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _placed(pivots: np.ndarray, width: int):
    centres = pivots.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = (centres**2).sum(axis=1)
        for batch in batches:
            x = _matrix(batch.column("vector"), width).astype(np.float64)
            cell = (square - 2 * x @ centres.T).argmin(axis=1).astype(np.int32)
            away = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1)) * (1 + 1e-12)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(away), batch.column("vector"), batch.column("ids")], ["cell", "away", "vector", "ids"])

    return run


def _bounds(pivots: np.ndarray, radii: np.ndarray, width: int, rest: bool):
    """Rows (number, cell): the cell of the best bound, or all cells whose bound reaches the query's floor."""
    centres = pivots.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.sqrt((centres**2).sum(axis=1)).max(initial=0) + radii[radii > -np.inf].max(initial=0)
        for batch in batches:
            q = _matrix(batch.column("vector"), width).astype(np.float64)
            norm = np.sqrt((q**2).sum(axis=1))
            bound = q @ centres.T + norm[:, None] * radii
            bound[:, radii == -np.inf] = -np.inf
            if rest:
                floor = batch.column("floor").to_numpy(zero_copy_only=False) - 1e-9 * (1 + norm * top * width)
                row, cell = np.nonzero((bound >= floor[:, None]) & (radii > -np.inf))
            else:
                row, cell = np.arange(len(q)), bound.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("number").take(pa.array(row)), pa.array(cell.astype(np.int32))], ["number", "cell"])

    return run


def _searched(width: int, k: int):
    """Rows (pair, side, ...): a block's tree is built from its entries, then its queries are asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "pair"):
            side = rows.column("side").to_numpy()
            entries, asked = rows.filter(pa.array(side == 0)), rows.filter(pa.array(side == 1))
            if not entries.num_rows or not asked.num_rows:
                continue
            tree = Tree(_matrix(entries.column("vector"), width), entries.column("ids").to_pylist())
            for low in range(0, asked.num_rows, QUERIES):
                part = asked.slice(low, QUERIES)
                own, numbers = part.column("query_id").to_numpy(), part.column("number").to_pylist()
                query, number, scores, ids = [], [], [], []
                for at, found in enumerate(tree.search(_matrix(part.column("vector"), width), k, own, part.column("floor").to_numpy())):
                    for score, entry in found:
                        query.append(int(own[at]))
                        number.append(numbers[at])
                        scores.append(score)
                        ids.append([i for i in tree.ids[entry] if i != own[at]][:k])
                columns = [pa.array(query, pa.int64()), pa.array(number, pa.int64()), pa.array(scores, pa.int64()), pa.array(ids, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "number", "score", "ids"])

    return run


def _turn(width: int) -> int:
    """Queries that meet one copy of a block: 32 MB of them, at least ``QUERIES``."""
    return max(QUERIES, (32 << 20) // (8 * max(width, 1)))


def _asked(blocks: DataFrame, wanted: DataFrame, width: int, k: int) -> DataFrame:
    """(query_id, number, score, ids) of ``wanted`` (cell, part, number, query_id, vector, floor) in their blocks."""
    turns = wanted.groupBy("cell", "part").agg(F.ceil(F.count("*") / _turn(width)).cast("int").alias("turns"))
    entries = blocks.join(turns, ["cell", "part"]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    none = F.lit(None).cast("long")
    left = entries.select("cell", "part", "turn", F.lit(0).alias("side"), none.alias("query_id"), none.alias("number"), F.lit(0.0).alias("floor"), "vector", "ids")
    dealt = wanted.join(turns, ["cell", "part"]).withColumn("turn", F.pmod(F.xxhash64("number"), F.col("turns")).cast("int"))
    right = dealt.select("cell", "part", "turn", F.lit(1).alias("side"), "query_id", "number", "floor", "vector", F.array().cast("array<long>").alias("ids"))
    pairs = left.unionByName(right).withColumn("pair", F.xxhash64("cell", "part", "turn"))
    found = pairs.repartition("pair").sortWithinPartitions("pair")
    return found.mapInArrow(_searched(width, k), "query_id long, number long, score long, ids array<long>")


def top_products(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each id divisible by ``every`` its k best rows of other ids."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "mtree")
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), F.coalesce(finite, F.lit(False)).alias("ok"))
    known = known.filter("vec_id IS NOT NULL AND ok").select("vec_id", F.transform("x", lambda v: F.floor(v * SCALE)).alias("vector"))
    known = known.groupBy("vector", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"))
    first = Window.partitionBy("vector").orderBy("vec_id")
    few = known.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    ids = F.array_sort(F.flatten(F.collect_list(F.array_repeat("vec_id", F.col("times")))))
    entries = scratch.store(few.groupBy("vector").agg(ids.alias("ids")))
    n, width = entries.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    asked = known.filter(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "vector")
    asked = scratch.store(asked.withColumn("number", F.monotonically_increasing_id()))
    sample = entries.orderBy(F.xxhash64("vector"), "vector").limit(min(PIVOTS, n // BLOCK + 1)).select("vector").toArrow()
    pivots = _matrix(sample.column("vector"), width) if n else np.zeros((1, width), np.int64)
    placed = scratch.store(entries.mapInArrow(_placed(pivots, width), "cell int, away double, vector array<long>, ids array<long>"))
    sized = scratch.store(placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), F.max("away").alias("radius")))
    radii = np.full(len(pivots), -np.inf)
    for row in sized.collect():  # at most PIVOTS rows
        radii[row.cell] = row.radius
    cells = F.broadcast(sized.select("cell", "parts"))
    blocks = placed.join(cells, "cell").select("cell", F.pmod(F.xxhash64("vector"), F.col("parts")).cast("int").alias("part"), "vector", "ids")
    where = "number long, cell int"
    home = asked.mapInArrow(_bounds(pivots, radii, width, False), where).join(cells, "cell")
    home = scratch.store(home.select("number", "cell", F.pmod(F.xxhash64("number"), F.col("parts")).cast("int").alias("part")))
    lowest = F.lit(float("-inf"))
    near = scratch.store(_asked(blocks, home.join(asked, "number").withColumn("floor", lowest), width, k))
    floors = near.groupBy("number").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
    bounded = scratch.store(asked.join(floors, "number", "left").withColumn("floor", F.coalesce("floor", lowest)))
    others = bounded.mapInArrow(_bounds(pivots, radii, width, True), where).join(cells, "cell")
    others = others.select("number", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    others = scratch.store(others.join(home, ["number", "cell", "part"], "left_anti"))
    found = near.unionByName(_asked(blocks, others.join(bounded, "number"), width, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("ids")[0])
    rows = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).select("query_id", "score", F.explode("ids").alias("vec_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = rows.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
