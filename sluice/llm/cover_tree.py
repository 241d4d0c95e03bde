"""Hard negatives by cover trees over norm-augmented vectors.

A coordinate is added to the rows of a tree that gives all of them the same length, and 0 to anchors; the distance of
a row from an anchor then falls as their inner product rises.  A node of the tree covers the rows below it within a
radius, and the radii halve from level to level, so that the inner products below a node lie between bounds
that its centre's own product and its radius give.

A search visits nodes by their upper bounds, the best first.  Nodes outside every window of scores that is asked for, or under the
last of the best rows already found for it, are skipped with all below.  Leaves are scored in integers, which is
exact; bounds carry a slack for the rounding of distances.

Trees hold rows of one label and a bounded number of different vectors; equal vectors are one leaf with
their smallest ids.  They are stored once and read by each pass over them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.batches import stored
from sluice.llm.multi_index import matrix_of

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW_PCT, HIGH_PCT = 30, 90
TREE_ROWS = 2048
TASK_ROWS = 50_000
ANCHOR_BLOCK = 8192
OUTGROWN = 1 << 26

TREE_SCHEMA = "label long, width long, points binary, starts binary, ids binary, children binary, radii binary"
PAIR_SCHEMA = "anchor_id long, positive_id long, vec_id long, score long"


@dataclass(frozen=True)
class Tree:
    """Different vectors of one label, with a node for each: node i is centred on vector ``centres[i]``.

    ``children`` gives the first child of each node and the one after its last; a node without is a leaf.  ``radii`` are the
    distances from the centres to the furthest rows below.  The ids of vector j lie from ``starts[j]`` on.
    """

    points: np.ndarray
    starts: np.ndarray
    ids: np.ndarray
    centres: np.ndarray
    children: np.ndarray
    radii: np.ndarray
    length2: float

    @classmethod
    def build(cls, points: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> Tree:
        """A cover tree of different integer vectors; nodes stand in the order in which they are reached."""
        norms = (points.astype(float) ** 2).sum(axis=1)
        length2 = float(norms.max())
        products = points.astype(float) @ points.T.astype(float)
        extra = np.sqrt(np.maximum(length2 - norms, 0.0))
        distances = np.sqrt(np.maximum(2 * length2 - 2 * (products + np.outer(extra, extra)), 0.0))
        centres, children, radii = [0], [], []
        below = [np.arange(len(points))]
        at = 0
        while at < len(centres):
            rows, centre = below[at], centres[at]
            below[at] = rows[:0]
            own = distances[centre, rows]
            radii.append(float(own.max()))
            children.append([len(centres), len(centres)])
            if len(rows) > 1:
                for chosen, members in _covers(distances, rows, centre, radii[-1] / 2):
                    centres.append(chosen)
                    below.append(members)
                children[-1][1] = len(centres)
            at += 1
        return cls(points, starts, ids, np.array(centres), np.array(children), np.array(radii), length2)

    def row(self, label: int) -> tuple:
        """Values of TREE_SCHEMA."""
        nodes = np.column_stack([self.centres, self.children]).astype("<i8")
        return (
            label, self.points.shape[1], self.points.astype("<i4").tobytes(), self.starts.astype("<i8").tobytes(),
            self.ids.astype("<i8").tobytes(), nodes.tobytes(), self.radii.astype("<f8").tobytes(),
        )

    @classmethod
    def of_row(cls, width: int, points: bytes, starts: bytes, ids: bytes, children: bytes, radii: bytes) -> Tree:
        starts = np.frombuffer(starts, "<i8")
        vectors = np.frombuffer(points, "<i4").reshape(len(starts) - 1, width).astype(np.int64)
        nodes = np.frombuffer(children, "<i8").reshape(-1, 3)
        length2 = float((vectors.astype(float) ** 2).sum(axis=1).max())
        return cls(
            vectors, starts, np.frombuffer(ids, "<i8"), nodes[:, 0], nodes[:, 1:], np.frombuffer(radii, "<f8"), length2
        )


def _covers(distances: np.ndarray, rows: np.ndarray, centre: int, radius: float) -> Iterator[tuple[int, np.ndarray]]:
    """Rows drawn as centres until all are within ``radius`` of one, the furthest row each time, and the rows nearest to each."""
    nearest = distances[centre, rows]
    whose = np.zeros(len(rows), np.int64)
    chosen = [centre]
    while True:
        furthest = int(nearest.argmax())
        if nearest[furthest] <= radius or nearest[furthest] == 0.0:
            break
        own = distances[rows[furthest], rows]
        closer = own < nearest
        closer[furthest] = True
        whose[closer] = len(chosen)
        nearest = np.minimum(own, nearest)
        nearest[furthest] = 0.0
        chosen.append(int(rows[furthest]))
    if len(chosen) == 1:
        # Rounding has made different rows one: each is a leaf.
        chosen, whose = rows.tolist(), np.arange(len(rows))
    order = np.argsort(whose, kind="stable")
    cuts = np.searchsorted(whose[order], np.arange(1, len(chosen)))
    yield from zip(chosen, np.split(rows[order], cuts), strict=True)


class Best:
    """The k best rows of one window of scores; of equal scores the smaller ids."""

    def __init__(self, low: float, high: float, k: int) -> None:
        self.low, self.high, self.k = low, high, k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> float:
        """A score under this one cannot come in."""
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.least) & (scores <= self.high)
        if fits.any():
            scores, ids = np.append(self.scores, scores[fits]), np.append(self.ids, ids[fits])
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]


def search(tree: Tree, anchor: np.ndarray, windows: list[Best], but: int | None = None) -> int:
    """Puts the rows of a tree into the windows of an anchor, best first; gives the number of nodes scored.

    ``but`` is the id of a row that takes no part.
    """
    length2 = tree.length2 + float((anchor.astype(float) ** 2).sum())
    slack = 1e-9 * length2 + 1e-9

    def between(scores: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the products below nodes with these products."""
        distance = np.sqrt(np.maximum(length2 - 2.0 * scores, 0.0))
        high = (length2 - np.maximum(distance - radii, 0.0) ** 2) / 2 + slack
        low = (length2 - (distance + radii) ** 2) / 2 - slack
        return low, high

    def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.zeros(len(low), bool)
        for window in windows:
            out |= (high >= window.least) & (low <= window.high)
        return out

    def verify(nodes: np.ndarray, scores: np.ndarray) -> None:
        """Leaves give all ids of their vectors: at most one more than a window holds."""
        vectors = tree.centres[nodes]
        sizes = tree.starts[vectors + 1] - tree.starts[vectors]
        at = np.repeat(tree.starts[vectors] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        ids, own = tree.ids[at], np.repeat(scores, sizes)
        if but is not None:
            own, ids = own[ids != but], ids[ids != but]
        for window in windows:
            window.add(own, ids)

    scored = 1
    first = tree.points[tree.centres[:1]] @ anchor
    if tree.children[0, 0] == tree.children[0, 1]:
        verify(np.zeros(1, np.int64), first)
        return scored
    low, high = between(first, tree.radii[:1])
    heap = [(-float(high[0]), float(low[0]), 0)] if wanted(low, high)[0] else []
    while heap:
        above, under, node = heapq.heappop(heap)
        if not any(-above >= w.least and under <= w.high for w in windows):
            continue
        nodes = np.arange(*tree.children[node])
        scores = tree.points[tree.centres[nodes]] @ anchor
        scored += len(nodes)
        leaf = tree.children[nodes, 0] == tree.children[nodes, 1]
        if leaf.any():
            verify(nodes[leaf], scores[leaf])
        inner = ~leaf
        if inner.any():
            low, high = between(scores[inner], tree.radii[nodes[inner]])
            keep = wanted(low, high)
            for item in zip((-high[keep]).tolist(), low[keep].tolist(), nodes[inner][keep].tolist(), strict=True):
                heapq.heappush(heap, item)
    return scored


def _trees(rows: DataFrame, held: int) -> DataFrame:
    """Trees of the rows of each task, of up to TREE_ROWS rows of one label; ``held`` ids of equal vectors are kept."""

    def tree_of(label: int, tables: list[pa.Table]) -> tuple:
        table = pa.concat_tables(tables)
        ids, points = table.column("vec_id").to_numpy(), matrix_of(table).astype(np.int64)
        order = np.lexsort((ids, *points.T))
        ids, points = ids[order], points[order]
        new = np.append(True, (points[1:] != points[:-1]).any(axis=1))
        group = np.cumsum(new) - 1
        begins = np.flatnonzero(new)
        keep = np.arange(len(ids)) - begins[group] < held
        starts = np.append(0, np.cumsum(np.bincount(group[keep], minlength=len(begins))))
        return Tree.build(points[new], starts, ids[keep]).row(label)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in TREE_SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        kept: list[pa.Table] = []
        label = None

        def flush() -> pa.RecordBatch:
            values = tree_of(label, kept)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            labels = table.column("label").to_numpy()
            cuts = np.flatnonzero(np.append(True, labels[1:] != labels[:-1])).tolist()
            for start, end in zip(cuts, [*cuts[1:], len(labels)], strict=True):
                if kept and labels[start] != label:
                    yield flush()
                    kept = []
                label = int(labels[start])
                while start < end:
                    take = min(end - start, TREE_ROWS - sum(t.num_rows for t in kept))
                    kept.append(table.slice(start, take))
                    start += take
                    if sum(t.num_rows for t in kept) == TREE_ROWS:
                        yield flush()
                        kept = []
        if kept:
            yield flush()

    return rows.mapInArrow(build, TREE_SCHEMA)


def _trees_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Tree]]:
    names = ("width", "points", "starts", "ids", "children", "radii")
    for batch in batches:
        for i, label in enumerate(batch.column("label").to_pylist()):
            yield label, Tree.of_row(*(batch.column(n)[i].as_py() for n in names))


def _pairs(anchors: list[int], positives: list[int | None], found: list[Best]) -> pa.RecordBatch:
    sizes = [len(b.ids) for b in found]
    empty = np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.array(anchors, np.int64), sizes)),
            pa.array(np.repeat(np.array([-1 if p is None else p for p in positives], np.int64), sizes)),
            pa.array(np.concatenate([*(b.ids for b in found), empty])),
            pa.array(np.concatenate([*(b.scores for b in found), empty])),
        ],
        ["anchor_id", "positive_id", "vec_id", "score"],
    )


def _positives(trees: DataFrame, anchors: dict[int, tuple[int, np.ndarray]], k: int) -> DataFrame:
    """The k best other rows of the anchor's label, from each task."""
    held = trees.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: Best(-np.inf, np.inf, k) for i in held.value}
        for label, tree in _trees_of(batches):
            for i, (own, vector) in held.value.items():
                if own == label:
                    search(tree, vector, [best[i]], i)
        yield _pairs(list(best), [None] * len(best), list(best.values()))

    return trees.mapInArrow(run, PAIR_SCHEMA)


def _negatives(
    trees: DataFrame,
    anchors: dict[int, tuple[int, np.ndarray]],
    positives: dict[int, list[tuple[int, int]]],
    k: int,
    low_pct: int,
    high_pct: int,
) -> DataFrame:
    """The k best rows of other labels in the window of each anchor and positive, from each task."""
    held = trees.sparkSession.sparkContext.broadcast((anchors, positives))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, asked = held.value
        best = {
            i: [Best(-(-low_pct * score // 100), high_pct * score // 100, k) for _, score in pairs]
            for i, pairs in asked.items()
        }
        for label, tree in _trees_of(batches):
            for i, windows in best.items():
                if rows[i][0] != label:
                    search(tree, rows[i][1], windows)
        flat = [(i, p, b) for i, pairs in asked.items() for (p, _), b in zip(pairs, best[i], strict=True)]
        yield _pairs([f[0] for f in flat], [f[1] for f in flat], [f[2] for f in flat])

    return trees.mapInArrow(run, PAIR_SCHEMA)


def _ranked(pairs: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_pct: int = LOW_PCT,
    high_pct: int = HIGH_PCT,
    scale: int = SCALE,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the rows that ``anchors`` picks.

    Components are scaled and rounded down to integers; a score is an integer inner product.  The positives of an anchor are its
    best other rows of the same label, and its negatives for a positive the best rows of other labels that score
    between ``low_pct`` and ``high_pct`` per cent of the positive.  Ties go to the smaller id.  ``label`` defaults to the
    column of that name.

    Rows with a null id, label, vector or component, or with a component that is not finite, take no part, nor do vectors of
    another width than most or with a component beyond 2 ** 26 after scaling, whose products might leave 64 bits.  Of
    rows with the same id one takes part.  A zero vector takes part.  An anchor without positives, a positive without negatives,
    and an empty table give no rows.  Other columns are not looked at.

    Anchors are searched for in blocks, each against all trees; a task sends its best rows of each window only, whatever
    the number of its trees.
    """
    spark = vectors.sparkSession
    column = F.col(f"`{vector_column}`").cast("array<double>")
    label = F.col("label") if label is None else label
    scaled = F.transform(column, lambda x: F.floor(x * scale).cast("double"))
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.when(F.forall(column, lambda x: x.isNotNull() & (F.abs(x) * scale < OUTGROWN)), scaled).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    ).dropna(subset=["vec_id", "label", "vector"])
    width = rows.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").first()
    empty = spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    if width is None or not width["w"]:
        return empty
    rows = rows.filter(F.size("vector") == width["w"])
    if not rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "is_anchor")).alias("r")).select("vec_id", "r.*")
    rows = stored(rows, "scaled-vectors")
    parts = max(spark.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    dealt = rows.repartition(parts, "vec_id").sortWithinPartitions("label")
    trees = stored(_trees(dealt.select("vec_id", "label", "vector"), max(positives, negatives) + 1), "cover-trees")
    asked = rows.filter("is_anchor")
    blocks = max(1, -(-asked.count() // ANCHOR_BLOCK))
    found = None
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).select("vec_id", "label", "vector").toArrow()
        if not own.num_rows:
            continue
        points = matrix_of(own).astype(np.int64)
        held = {
            i: (group, point)
            for i, group, point in zip(own.column("vec_id").to_pylist(), own.column("label").to_pylist(), points, strict=True)
        }
        near = stored(_ranked(_positives(trees, held, positives), ["anchor_id"], positives), "positives")
        pairs: dict[int, list[tuple[int, int]]] = {}
        for row in near.select("anchor_id", "vec_id", "score").toLocalIterator():
            pairs.setdefault(row["anchor_id"], []).append((row["vec_id"], row["score"]))
        mined = _negatives(trees, held, pairs, negatives, low_pct, high_pct)
        mined = _ranked(mined, ["anchor_id", "positive_id"], negatives).withColumnsRenamed(
            {"vec_id": "negative_id", "score": "negative_score"}
        )
        scores = near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        part = stored(mined.join(scores, ["anchor_id", "positive_id"]), "hard-negatives")
        found = part if found is None else found.unionAll(part)
    return empty if found is None else found.select(empty.columns)
