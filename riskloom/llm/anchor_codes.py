"""Vectors compressed part by part to codebook indexes, with metric trees that settle whole balls.

Components become integers, vectors are cut into equal parts, and each part position has a
codebook that is refined in rounds: every part goes to the nearest entry, then every entry
becomes the mean of its parts. All arithmetic is on integers, so results don't depend on
partitions or their order.

A task packs its vectors into blocks and builds an anchors hierarchy per block and part
position, once, for all rounds: about sqrt(n) anchors grow one by one, each the point
farthest from its owner and stealing only points that the triangle inequality allows
(those beyond half the distance of both anchors); the anchors' balls are merged upwards to
one root and each is divided again in the same way, until it holds ``LEAF`` points. Each
ball caches the count and sum of its points. A round walks down the levels of a tree. A
ball inherits the entries that were still candidates for its parent and loses those which
another candidate beats for every place in the ball; with one left the ball is wholly
owned and its cached sum and count go to that entry. Only points of balls at the bottom
that are not owned are compared one by one, with their ball's candidates.

Blocks and trees are stored in the shared folder, so a lost executor costs one read; a
round sends sums per entry and task (a bounded table) and takes the new codebooks with the
code. A task holds one block of ``BLOCK`` vectors. The only shuffles over all rows are of
pre-aggregated errors per label.

Defined results: rows whose vector is null, or has null or non-finite components, are left
out; codebooks start from the smallest ``vec_id``, ties (repeated ids) by the vector, null
ids last, and have fewer entries if there are fewer vectors; repeated rows count as often as they
occur; null labels are one label; an empty table gives no rows. Vectors of different or
indivisible lengths, and components so large that squared distances leave 64 bits, are an
error. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.tables import Scratch, small

BLOCK = 4096
LEAF = 32
#: Relative slack of the bounds, which are computed in floating point.
SLACK = 1e-9


# --- trees (numpy, inside tasks) --------------------------------------------------------


def node_type(width: int) -> np.dtype:
    """A ball: its children (or -1), its points as a slice of the order, radius, and their sum."""
    return np.dtype([("left", "<i4"), ("right", "<i4"), ("first", "<i4"), ("n", "<i4"), ("radius", "<f8"), ("sum", "<i8", (width,))])


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    apart = points - to
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def anchors(points: np.ndarray) -> list[np.ndarray]:
    """The points in about sqrt(n) groups, each grown around an anchor."""
    owner, far = np.zeros(len(points), np.int64), _distances(points, points[0])
    pivots, wanted = [0], max(2, int(np.sqrt(len(points))))
    while len(pivots) < wanted:
        new = int(far.argmax())
        if far[new] == 0:
            break
        apart = _distances(points[pivots], points[new])
        near = np.flatnonzero(far > apart[owner] / 2)  # the others are nearer to their own anchor
        d = _distances(points[near], points[new])
        won = d < far[near]
        owner[near[won]], far[near[won]] = len(pivots), d[won]
        pivots.append(new)
    return np.split(np.argsort(owner, kind="stable"), np.cumsum(np.bincount(owner))[:-1])


def merges(centres: np.ndarray, radii: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of balls joined one after another, each time the pair with the smallest common ball.

    Balls are numbered on: the first pair makes ball number ``len(centres)``.
    """
    some, total = len(centres), 2 * len(centres) - 1
    c, r, n = np.zeros((total, centres.shape[1])), np.zeros(total), np.zeros(total)
    c[:some], r[:some], n[:some] = centres, radii, counts
    cost = np.full((total, total), np.inf)  # of each pair once, below the diagonal
    for i in range(1, some):
        cost[i, :i] = _distances(c[:i], c[i]) + r[:i] + r[i]
    best, at, pairs = cost.min(1), cost.argmin(1), []
    for new in range(some, total):
        a = int(best.argmin())
        b = int(at[a])
        pairs.append((a, b))
        n[new] = n[a] + n[b]
        c[new] = (n[a] * c[a] + n[b] * c[b]) / n[new]
        r[new] = (_distances(c[[a, b]], c[new]) + r[[a, b]]).max()
        cost[[a, b]], cost[:, [a, b]] = np.inf, np.inf
        best[[a, b]], n[[a, b]] = np.inf, 0
        lost = np.flatnonzero(((at == a) | (at == b)) & (best < np.inf))
        best[lost], at[lost] = cost[lost].min(1), cost[lost].argmin(1)
        cost[new, :new] = np.where(n[:new] > 0, _distances(c[:new], c[new]) + r[:new] + r[new], np.inf)
        best[new], at[new] = cost[new].min(), cost[new].argmin()
    return pairs


def grown(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the tree over ``points`` (root first, children after their parent) and the order of the points."""
    wide, nodes, order = points.astype(np.float64), [], []
    placed = 0

    def ball(members: np.ndarray) -> tuple[np.ndarray, float]:
        """Sum of the points, and their largest distance from the mean."""
        total = np.add.reduce(points[members])
        return total, float(_distances(wide[members], total / len(members)).max())

    def node(members: np.ndarray, total: np.ndarray, radius: float) -> int:
        nodes.append([-1, -1, placed, len(members), radius, total])
        return len(nodes) - 1

    def divide(at: int, members: np.ndarray) -> None:
        """The subtree below node ``at``; its points are placed one after another."""
        nonlocal placed
        groups = [members[g] for g in anchors(wide[members])] if len(members) > LEAF else []
        if len(groups) < 2:
            order.append(members)
            placed += len(members)
            return
        balls = [ball(g) for g in groups]
        sizes = np.array(list(map(len, groups)))
        pairs = merges(np.array([total for total, _ in balls]) / sizes[:, None], np.array([radius for _, radius in balls]), sizes)
        for a, b in pairs:
            groups.append(np.concatenate([groups[a], groups[b]]))

        def spread(k: int, above: int) -> None:
            for side, child in enumerate(pairs[k - len(balls)]):
                below = node(groups[child], *(balls[child] if child < len(balls) else ball(groups[child])))
                nodes[above][side] = below
                if child < len(balls):
                    divide(below, groups[child])
                else:
                    spread(child, below)

        spread(len(groups) - 1, at)

    everything = np.arange(len(points))
    divide(node(everything, *ball(everything)), everything)
    return np.array([tuple(n) for n in nodes], node_type(points.shape[1])), np.concatenate(order)


def nearest(points: np.ndarray, entries: np.ndarray, open_: np.ndarray | None = None) -> np.ndarray:
    """Index of the nearest entry, the lower one on a tie; exact, as all is in integers."""
    score = (entries**2).sum(1) - 2 * points @ entries.T  # less the point's own square
    return (score if open_ is None else np.where(open_, score, np.iinfo(np.int64).max)).argmin(1)


class Walk:
    """One round's walk down a tree: what every ball or point is assigned to."""

    def __init__(self, points: np.ndarray, nodes: np.ndarray, order: np.ndarray, entries: np.ndarray) -> None:
        self.entries, k = entries, len(entries)
        self.sums, self.counts = np.zeros((k, points.shape[1]), np.int64), np.zeros(k, np.int64)
        self.index = np.zeros(len(points), np.int64)
        self.compared = 0  # pairs of point and entry
        wide = entries.astype(np.float64)
        norms = (wide**2).sum(1)
        between = np.sqrt(((wide[:, None] - wide[None]) ** 2).sum(2))
        level, open_ = np.array([0]), np.ones((1, k), bool)
        while len(level):
            held = nodes[level]
            centre = held["sum"] / held["n"][:, None]
            # |x - entry|^2 - |x|^2, whose differences are linear in x
            score = np.where(open_, norms - 2 * centre @ wide.T, np.inf)
            best = score.argmin(1)
            gap = score - score[np.arange(len(level)), best][:, None]
            least = 2 * held["radius"][:, None] * between[best] + SLACK * (norms.max() + (centre**2).sum(1) + held["radius"] ** 2)[:, None]
            open_ = open_ & ~(gap > least)
            owned = open_.sum(1) == 1
            self._own(held[owned], best[owned], order)
            inner = ~owned & (held["left"] >= 0)
            self._compare(held[~owned & ~inner], open_[~owned & ~inner], points, order)
            level = np.concatenate([held["left"][inner], held["right"][inner]])
            open_ = np.concatenate([open_[inner]] * 2)

    def _own(self, balls: np.ndarray, entry: np.ndarray, order: np.ndarray) -> None:
        chosen = (entry == np.arange(len(self.entries))[:, None]).astype(np.int64)
        self.sums += chosen @ balls["sum"]
        self.counts += chosen @ balls["n"]
        self.index[order[_slices(balls)]] = np.repeat(entry, balls["n"])

    def _compare(self, balls: np.ndarray, open_: np.ndarray, points: np.ndarray, order: np.ndarray) -> None:
        rows = order[_slices(balls)]
        if not len(rows):
            return
        mask = np.repeat(open_, balls["n"], axis=0)
        self.compared += int(mask.sum())
        held = points[rows]
        self.index[rows] = index = nearest(held, self.entries, mask)
        self.sums += (index == np.arange(len(self.entries))[:, None]).astype(np.int64) @ held
        self.counts += np.bincount(index, minlength=len(self.entries))


def _slices(balls: np.ndarray) -> np.ndarray:
    ends = np.cumsum(balls["n"], dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(balls["first"] - (ends - balls["n"]), balls["n"])


# --- Spark ------------------------------------------------------------------------------


def _blocks(kept: DataFrame, width: int, parts: int) -> DataFrame:
    """Rows of up to ``BLOCK`` vectors: ids, labels, packed components, and a tree per part position."""
    id_type, label_type = (kept.schema[c].dataType for c in ("vec_id", "label"))
    schema = T.StructType().add("ids", T.ArrayType(id_type)).add("labels", T.ArrayType(label_type)).add("packed", T.BinaryType())
    schema = schema.add("nodes", T.ArrayType(T.BinaryType())).add("orders", T.ArrayType(T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                flat = part.column("parts").flatten().to_numpy(zero_copy_only=False)
                points = flat.reshape(part.num_rows, parts, width)
                trees = [grown(np.ascontiguousarray(points[:, p])) for p in range(parts)]
                ends = [0, part.num_rows]
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(ends, part.column("vec_id")), pa.ListArray.from_arrays(ends, part.column("label")),
                    pa.array([points.astype("<i4").tobytes()], pa.binary()),
                    pa.array([[nodes.tobytes() for nodes, _ in trees]]), pa.array([[order.astype("<i4").tobytes() for _, order in trees]]),
                ], schema.names)

    return kept.mapInArrow(run, schema)


def _walks(block: dict, width: int, codebooks: np.ndarray) -> Iterator[tuple[np.ndarray, Walk]]:
    """Points and walk of every part position of a stored block."""
    points = np.frombuffer(block["packed"], "<i4").astype(np.int64).reshape(-1, len(codebooks), width)
    for p, entries in enumerate(codebooks):
        nodes, order = np.frombuffer(block["nodes"][p], node_type(width)), np.frombuffer(block["orders"][p], "<i4")
        held = np.ascontiguousarray(points[:, p])
        yield held, Walk(held, nodes, order, entries)


def _step(blocks: DataFrame, width: int, codebooks: np.ndarray) -> np.ndarray:
    """The next codebooks: floored means of the parts of each entry; an unused one stays."""
    parts, entries = codebooks.shape[:2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for block in batch.to_pylist():
                for p, (_, walk) in enumerate(_walks(block, width, codebooks)):
                    total[p, :, :width] += walk.sums
                    total[p, :, width] += walk.counts
        place = np.flatnonzero(np.repeat(total[:, :, width].ravel() > 0, width + 1))
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(total.ravel()[place])], ["place", "total"])

    sums = blocks.select("packed", "nodes", "orders").mapInArrow(run, "place int, total long").groupBy("place").agg(F.sum("total"))
    total = np.zeros(parts * entries * (width + 1), np.int64)
    for place, value in sums.collect():  # a row per number of the codebooks
        total[place] = value
    total = total.reshape(parts, entries, width + 1)
    means = total[:, :, :width] // np.maximum(total[:, :, width:], 1)
    return np.where(total[:, :, width:] > 0, means, codebooks)


def compressed(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """Codes of all sound rows (vec_id, label, codes array, error), and the codebooks (parts, entries, width).

    At most 256 entries; ``error`` is the squared distance to the codes' entries, over all parts.
    """
    scratch = Scratch(vectors.sparkSession, "anchor-codes")
    cells = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    sound = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = vectors.filter(sound).select("vec_id", "label", "embedding", cells.alias("parts"))
    kept = whole.drop("embedding")
    facts = whole.agg(
        F.min(F.size("parts")).alias("low"), F.max(F.size("parts")).alias("high"),
        F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))).alias("largest"),
    ).first()
    id_type, label_type = (vectors.schema[c].dataType for c in ("vec_id", "label"))
    schema = T.StructType().add("vec_id", id_type).add("label", label_type).add("codes", T.ArrayType(T.IntegerType())).add("error", T.LongType())
    if facts.low is None:
        return vectors.sparkSession.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    if facts.low != facts.high or facts.low % parts or facts.low == 0:
        raise ValueError(f"vectors must have one length that {parts} divides; found {facts.low} to {facts.high}")
    width = facts.low // parts
    if 4.0 * width * (facts.largest * scale + 1) ** 2 >= 2.0**63:
        raise ValueError(f"components of {facts.largest} times {scale} are too large: squared distances leave 64 bits")

    first = kept.orderBy(F.asc_nulls_last("vec_id"), "parts").limit(entries).select("parts").collect()
    codebooks = np.array([r.parts for r in first], np.int64).reshape(len(first), parts, width).swapaxes(0, 1)
    blocks = scratch.store(_blocks(kept, width, parts))
    for _ in range(rounds):
        codebooks = _step(blocks, width, codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1)
                walked = list(_walks(block.to_pylist()[0], width, codebooks))
                codes = np.stack([w.index for _, w in walked], axis=1).astype(np.int32)
                error = sum(((held - w.entries[w.index]) ** 2).sum(1) for held, w in walked)
                listed = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, parts, dtype=np.int32), codes.ravel())
                yield pa.RecordBatch.from_arrays(
                    [block.column("ids").flatten(), block.column("labels").flatten(), listed, pa.array(error)], schema.names
                )

    out = scratch.store(blocks.mapInArrow(run, schema))
    scratch.drop(blocks)
    return out, codebooks


def with_label_error(codes: DataFrame) -> DataFrame:
    """Each row with the summed error of its label; rows without a label are one group."""
    totals = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return codes.join(small(totals), F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def codebook_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
