"""Exact nearest neighbours, and the votes they cast.

A small training side, by a checked number of values, is sent to every task.
Beyond that both sides are cut into cells around pivots and the cells into chunks
of bounded size; a query visits only the cells that can still hold one of its
nearest, which the triangle inequality tells without loss.  Queries of a cell are
held by a few tasks, through which the training rows of the cells they visit stream:
rows are copied once for each such task and a query's list is sent once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import cut_lineage

# the training side is broadcast up to this many vector components (32 MB as doubles)
BROADCAST_VALUES = 4_000_000
CHUNK_ROWS = 4_096
CELLS = 16
# queries that one task holds with their lists
HELD_QUERIES = 65_536
TASKS_PER_CORE = 2
NO_ID = np.iinfo(np.int64).max
NEAREST_SCHEMA = "query_id long, neighbor_id long, neighbor_label double, distance double"


def nearest_in_block(
    query_vectors: np.ndarray,
    query_groups: np.ndarray,
    vectors: np.ndarray,
    groups: np.ndarray,
    ids: np.ndarray,
    k: int,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the positions and distances of its ``k`` nearest vectors.

    Rows of the query's own group are passed over.  Ties go to the least id.  The
    matrix product only narrows the choice, with a margin for its rounding; the
    distances returned are summed from the differences.
    """
    found = []
    square = (vectors**2).sum(axis=1)
    largest = square.max(initial=0.0)
    step = max(1, 4_000_000 // max(1, len(vectors)))
    for start in range(0, len(query_vectors), step):
        part = query_vectors[start : start + step]
        rough = (part**2).sum(axis=1)[:, None] + square[None, :] - 2 * (part @ vectors.T)
        allowed = query_groups[start : start + step, None] != groups[None, :]
        rough = np.where(allowed, rough, np.inf)
        for vector, near, may in zip(part, rough, allowed, strict=True):
            if k < len(near):
                margin = 1e-9 * (1 + (vector**2).sum() + largest)
                limit = np.partition(near, k - 1)[k - 1] + margin
                chosen = np.flatnonzero((near <= limit) & may)
            else:
                chosen = np.flatnonzero(may)
            distance = np.sqrt(((vectors[chosen] - vector) ** 2).sum(axis=1))
            order = np.lexsort((ids[chosen], distance))[:k]
            found.append((chosen[order], distance[order]))
    return found


def _block_frame(queries: pd.DataFrame, train: pd.DataFrame, k: int) -> pd.DataFrame:
    ids = train["id"].to_numpy()
    labels = train["label"].to_numpy(dtype="float64")
    found = nearest_in_block(
        np.stack(queries["vector"].to_numpy()).astype("float64"),
        queries["grp"].to_numpy(),
        np.stack(train["vector"].to_numpy()).astype("float64"),
        train["grp"].to_numpy(),
        ids,
        k,
    )
    counts = [len(chosen) for chosen, _ in found]
    chosen = np.concatenate([c for c, _ in found]) if found else np.empty(0, dtype=int)
    return pd.DataFrame(
        {
            "query_id": np.repeat(queries["id"].to_numpy(), counts),
            "neighbor_id": ids[chosen],
            "neighbor_label": labels[chosen],
            "distance": np.concatenate([d for _, d in found]) if found else np.empty(0),
        }
    )


def _sides(df: DataFrame, id_col: str, vector: str, label: str, group: str) -> DataFrame:
    """Only what the search needs, under fixed names."""
    return df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        (F.col(label) if label in df.columns else F.lit(None)).cast("double").alias("label"),
        F.col(group).cast("long").alias("grp"),
    )


def nearest_neighbors(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    id_col: str = "id",
    vector: str = "vector",
    label: str = "label",
    apart: str | None = None,
    broadcast_values: int = BROADCAST_VALUES,
    chunk_rows: int = CHUNK_ROWS,
    cells: int = CELLS,
) -> DataFrame:
    """The ``k`` nearest training rows of each query by Euclidean distance.

    Columns: ``query_id, rank, neighbor_id, neighbor_label, distance``; ties go to
    the least id.  Rows with equal ``apart`` are never neighbours; by default that is
    the id, so a table can be searched against itself.
    """
    q = _sides(queries, id_col, vector, label, apart or id_col)
    t = _sides(train, id_col, vector, label, apart or id_col)
    first = t.select(F.size("vector").alias("n")).first()
    if first is None:
        raise ValueError("the training table is empty")
    limit = max(0, broadcast_values // max(1, first.n))
    if t.limit(limit + 1).count() <= limit:
        nearest = _against_broadcast(q, t, k)
    else:
        kinds = {df.schema[vector].dataType.simpleString() for df in (queries, train)}
        nearest = _against_cells(q, t, k, chunk_rows, cells, kinds == {"array<float>"})
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    ranked = nearest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "neighbor_id", "neighbor_label", "distance")


def _against_broadcast(queries: DataFrame, train: DataFrame, k: int) -> DataFrame:
    shared = queries.sparkSession.sparkContext.broadcast(train.toPandas())

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield _block_frame(batch, shared.value, k)

    return queries.mapInPandas(search, NEAREST_SCHEMA)


def _against_cells(
    queries: DataFrame, train: DataFrame, k: int, chunk_rows: int, cells: int, narrow: bool = False
) -> DataFrame:
    pivots = _pivots(train, cells)
    in_cell = train.withColumn("cell", _nearest_pivot(pivots)("vector"))
    in_cell = in_cell.select("id", "vector", "label", "grp", "cell.cell", "cell.distance")
    stats = {
        row.cell: (row.n, row.radius)
        for row in in_cell.groupBy("cell")
        .agg(F.count("*").alias("n"), F.max("distance").alias("radius"))
        .collect()
    }
    chunks = {cell: max(1, -(-n // chunk_rows)) for cell, (n, _) in stats.items()}
    in_chunk = in_cell.withColumn("chunk", _spread("id", "cell", chunks))

    # one chunk of the query's own cell gives an upper bound of its k-th distance
    at_home = queries.withColumn("home", _nearest_pivot(pivots, sorted(stats))("vector"))
    at_home = at_home.select("id", "vector", "label", "grp", F.col("home.cell").alias("cell"))
    at_home = at_home.withColumn("chunk", _spread("id", "cell", chunks))
    seen = _block_join(at_home, in_chunk, k, chunk_rows)
    bound = seen.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.max("distance")).alias("bound")
    )
    bounded = at_home.join(bound, at_home["id"] == bound["query_id"], "left").drop("query_id")
    # vectors of floats are moved as such, which loses nothing
    kind = "array<float>" if narrow else "array<double>"
    visits = cut_lineage(
        bounded.select(
            "id", F.col("vector").cast(kind).alias("vector"), "label", "grp", "cell",
            _cells_to_visit(pivots, stats)("vector", "bound").alias("cells"),
        )
    )
    sizes = {row.cell: row.n for row in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    return _streamed(visits, in_cell.withColumn("vector", F.col("vector").cast(kind)), k, sizes)


def _streamed(visits: DataFrame, in_cell: DataFrame, k: int, sizes: dict[int, int]) -> DataFrame:
    """Nearest rows of each query among those of the cells it visits.

    The queries of a cell, of which there are ``sizes``, are dealt to some tasks; the training rows of all cells that
    one of a task's queries visits are sent to it after them.
    """
    tasks = TASKS_PER_CORE * visits.sparkSession.sparkContext.defaultParallelism
    total = sum(sizes.values())
    parts = {c: max(1, round(tasks * n / total), -(-n // HELD_QUERIES)) for c, n in sizes.items()}
    first = dict(zip(sorted(parts), np.cumsum([0, *[parts[c] for c in sorted(parts)]]).tolist(), strict=False))
    count = sum(parts.values())
    if not count:
        return visits.sparkSession.createDataFrame([], NEAREST_SCHEMA)
    task = (_per_cell("cell", first) + _spread("id", "cell", parts)).cast("int")
    held = visits.select(task.alias("task"), F.lit(0).alias("side"), "id", "vector", "label", "grp", "cells")
    wanted = held.select("task", F.explode("cells").alias("cell")).distinct()
    sent = in_cell.join(F.broadcast(wanted), "cell").select("task", F.lit(1).alias("side"), "id", "vector", "label", "grp")
    both = held.drop("cells").unionByName(sent).repartitionById(count, "task").sortWithinPartitions("side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, queries, waiting, rows = None, [], [], 0
        for batch in batches:
            side = batch.column("side").to_numpy()
            queries.append(batch.filter(pa.array(side == 0)))
            waiting.append(batch.filter(pa.array(side == 1)))
            rows += int((side == 1).sum())
            if rows >= CHUNK_ROWS:
                found = found or NearestLists(pa.Table.from_batches(queries), k)
                found.add(pa.Table.from_batches(waiting))
                queries, waiting, rows = [], [], 0
        if found is None and queries:
            found = NearestLists(pa.Table.from_batches(queries), k)
        if rows:
            found.add(pa.Table.from_batches(waiting))
        if found is not None:
            yield from found.batches()

    return both.mapInArrow(run, NEAREST_SCHEMA)


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, groups, which groups are null, and vectors; a null id is ``NO_ID``."""
    vectors = table.column("vector").combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
    grp = table.column("grp")
    return (
        table.column("id").fill_null(NO_ID).to_numpy(), grp.fill_null(0).to_numpy(),
        grp.is_null().to_numpy(), flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0)),
    )


class NearestLists:
    """The ``k`` nearest so far of each of some queries, of rows that come in parts.

    Products of four-byte numbers only narrow the choice, with a margin for their rounding; the
    distances kept are summed from the differences.  Ties go to the least id.
    """

    def __init__(self, queries: pa.Table, k: int):
        self.ids, self.groups, self.apart, self.vectors = _columns(queries)
        n, self.k = len(self.ids), k
        self.squares = (self.vectors**2).sum(axis=1)
        self.distance = np.full((n, k), np.inf)
        self.near = np.full((n, k), NO_ID)
        self.label = np.full((n, k), np.nan)

    def add(self, rows: pa.Table) -> None:
        ids, groups, apart, vectors = _columns(rows)
        if not len(self.ids):
            return
        label = rows.column("label").to_numpy().astype("float64")
        squares = (vectors**2).sum(axis=1)
        largest = max(squares.max(initial=0.0), self.squares.max(initial=0.0))
        # beyond this the squares of four-byte numbers could overflow, or vanish
        small, kind = (1.2e-7 * (vectors.shape[1] + 8), "float32") if 1e-20 < largest < 1e30 else (1e-9, "float64")
        turned, rough_squares = vectors.astype(kind).T, squares.astype(kind)
        step = max(1, 4_000_000 // len(ids))
        for start in range(0, len(self.ids), step):
            at = slice(start, start + step)
            rough = self.vectors[at].astype(kind) @ turned
            rough *= -2
            rough += rough_squares
            # what is compared leaves out the query's own square, which is the same in its row
            rough[(self.groups[at, None] == groups) & ~self.apart[at, None] & ~apart] = np.inf
            margin = small * (largest + self.squares[at]) + (1e-9 if kind == "float64" else 0.0)
            limit = self.distance[at, -1] ** 2 - self.squares[at] + margin
            fresh = np.flatnonzero(np.isinf(limit))
            if len(fresh) and self.k < len(ids):
                limit[fresh] = np.partition(rough[fresh], self.k - 1, axis=1)[:, self.k - 1] + 2 * margin[fresh]
            which, chosen = np.nonzero((rough <= limit[:, None].astype("float64")) & (rough < np.inf))
            if len(which):
                which += start
                away = np.sqrt(((vectors[chosen] - self.vectors[which]) ** 2).sum(axis=1))
                self._merge(which, away, ids[chosen], label[chosen])

    def _merge(self, which: np.ndarray, away: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
        """Put further rows into the lists of the queries ``which``."""
        own = np.unique(which)
        held = np.repeat(own, self.k)
        query = np.concatenate([held, which])
        away = np.concatenate([self.distance[own].ravel(), away])
        ids = np.concatenate([self.near[own].ravel(), ids])
        label = np.concatenate([self.label[own].ravel(), label])
        order = np.lexsort((ids, away, query))
        begins = np.flatnonzero(np.append(True, np.diff(query[order]) > 0))
        place = order[(begins[:, None] + np.arange(self.k)).ravel()]
        shape = (len(own), self.k)
        self.distance[own], self.near[own], self.label[own] = (x[place].reshape(shape) for x in (away, ids, label))

    def batches(self, step: int = 4_096) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(self.ids), step):
            at = slice(start, start + step)
            full = np.isfinite(self.distance[at])
            query = np.repeat(self.ids[at], full.sum(axis=1))
            near, label, distance = self.near[at][full], self.label[at][full], self.distance[at][full]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query, mask=query == NO_ID), pa.array(near, mask=near == NO_ID),
                    pa.array(label, from_pandas=True), pa.array(distance),
                ],
                ["query_id", "neighbor_id", "neighbor_label", "distance"],
            )


def _pivots(train: DataFrame, cells: int) -> np.ndarray:
    """Vectors of the training rows with the least hashes: a fixed, small sample."""
    rows = train.orderBy(F.md5(F.col("id").cast("string"))).limit(cells).collect()
    return np.array([row.vector for row in rows], dtype="float64")


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))


def _nearest_pivot(pivots: np.ndarray, only: list[int] | None = None):
    numbers = np.arange(len(pivots)) if only is None else np.array(only)
    schema = T.StructType(
        [T.StructField("cell", T.IntegerType()), T.StructField("distance", T.DoubleType())]
    )

    @F.pandas_udf(schema)
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame({"cell": [], "distance": []}).astype({"cell": "int32"})
        away = _distances(np.stack(vectors.to_numpy()), pivots[numbers])
        best = away.argmin(axis=1)
        cell = numbers[best].astype("int32")
        return pd.DataFrame({"cell": cell, "distance": away[np.arange(len(best)), best]})

    return nearest


def _cells_to_visit(pivots: np.ndarray, stats: dict[int, tuple[int, float]]):
    """Cells that may hold a row nearer than the bound; all of them without a bound."""
    numbers = np.array(sorted(stats))
    radius = np.array([stats[c][1] for c in numbers])

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def visit(vectors: pd.Series, bounds: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        away = _distances(np.stack(vectors.to_numpy()), pivots[numbers])
        limit = bounds.fillna(np.inf).to_numpy(dtype="float64")[:, None]
        reach = away - radius[None, :] <= limit * (1 + 1e-9) + 1e-9
        return pd.Series([numbers[row].astype("int32").tolist() for row in reach])

    return visit


def _per_cell(cell: str, numbers: dict[int, int]):
    table = F.create_map(*[F.lit(x) for pair in sorted(numbers.items()) for x in pair])
    return table[F.col(cell)]


def _spread(id_col: str, cell: str, chunks: dict[int, int]):
    return F.pmod(F.xxhash64(F.col(id_col)), _per_cell(cell, chunks)).cast("int")


def _block_join(queries: DataFrame, train: DataFrame, k: int, chunk_rows: int) -> DataFrame:
    """Nearest rows within each pair of a training chunk and a block of its queries.

    Queries of a chunk go into blocks of about ``chunk_rows``; the chunk is copied
    to each block, so no task ever holds more than the two.
    """
    counts = queries.groupBy("cell", "chunk").agg(F.count("*").alias("n"))
    blocks = counts.select("cell", "chunk", F.ceil(F.col("n") / chunk_rows).cast("int").alias("m"))
    sized = queries.join(blocks, ["cell", "chunk"])
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.col("m")).cast("int")
    left = sized.select("id", "vector", "grp", "cell", "chunk", block.alias("block"))
    copied = train.join(blocks, ["cell", "chunk"]).select(
        "id", "vector", "label", "grp", "cell", "chunk",
        F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("block"),
    )
    keys = ["cell", "chunk", "block"]

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame(
                {"query_id": [], "neighbor_id": [], "neighbor_label": [], "distance": []}
            )
        return _block_frame(a, b, k)

    return left.groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInPandas(search, NEAREST_SCHEMA)


def vote(neighbors: DataFrame, weights: str = "uniform") -> DataFrame:
    """The label with most votes per query; equal votes go to the least label.

    With ``weights="distance"`` a vote counts one over the distance; where a
    neighbour has distance zero, only such neighbours vote.
    """
    if weights not in ("uniform", "distance"):
        raise ValueError("weights must be 'uniform' or 'distance'")
    rows = neighbors
    share = F.lit(1.0)
    if weights == "distance":
        exact = F.min("distance").over(Window.partitionBy("query_id")) == 0
        zero = (F.col("distance") == 0).cast("double")
        rows = rows.withColumn("_exact", exact)
        share = F.when(F.col("_exact"), zero).otherwise(1 / F.nullif("distance", F.lit(0.0)))
    totals = (
        rows.withColumn("_share", share)
        .groupBy("query_id", "neighbor_label")
        .agg(F.round(F.sum("_share"), 9).alias("votes"))
    )
    best = F.min(F.struct((-F.col("votes")).alias("v"), "neighbor_label"))
    return totals.groupBy("query_id").agg(best.alias("b")).select(
        "query_id",
        F.col("b.neighbor_label").alias("prediction"),
        (-F.col("b.v")).alias("votes"),
    )


def votes_of_all_settings(
    distances: np.ndarray, labels: np.ndarray, k_max: int
) -> dict[str, np.ndarray]:
    """Predicted label for every number of neighbours 1..k_max under both weightings."""
    classes = np.unique(labels)
    member = (labels[:, None] == classes[None, :]).astype("float64")
    exact = distances == 0
    with np.errstate(divide="ignore"):
        share = np.where(exact, 0.0, 1.0 / distances)
    if exact.any():
        share = exact.astype("float64")
    out = {}
    for name, weight in (("uniform", np.ones(len(labels))), ("distance", share)):
        running = np.round(np.cumsum(member * weight[:, None], axis=0), 9)
        best = classes[running.argmax(axis=1)]
        # where there are fewer neighbours than asked for, all of them vote
        out[name] = np.concatenate([best, np.repeat(best[-1:], k_max - len(best))])
    return out


def search_scores(
    train: DataFrame,
    k_max: int = 49,
    id_col: str = "id",
    vector: str = "vector",
    label: str = "label",
    fold: str = "fold",
    **sizes: int,
) -> DataFrame:
    """Mean accuracy over the folds of every setting: ``(n_neighbors, weights, score)``.

    One list of the ``k_max`` nearest rows outside the own fold answers all settings.
    """
    lists = nearest_neighbors(train, train, k_max, id_col, vector, label, fold, **sizes)
    gathered = lists.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "distance", "neighbor_label"))).alias("near")
    )
    truth = train.select(
        F.col(id_col).alias("query_id"), F.col(label).cast("double").alias("_truth"), F.col(fold)
    )
    kinds = ("uniform", "distance")

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def hits(distance: pd.Series, near: pd.Series, truth: pd.Series) -> pd.Series:
        rows = []
        for d, y, t in zip(distance, near, truth, strict=True):
            voted = votes_of_all_settings(np.asarray(d), np.asarray(y), k_max)
            rows.append(np.concatenate([voted[kind] == t for kind in kinds]).astype("int32"))
        return pd.Series(rows)

    hit = hits("near.distance", "near.neighbor_label", "_truth")
    settings = F.array(
        *[
            F.struct(F.lit(k).alias("n_neighbors"), F.lit(kind).alias("weights"))
            for kind in kinds
            for k in range(1, k_max + 1)
        ]
    )
    zipped = F.arrays_zip(settings.alias("s"), hit.alias("hit"))
    per_fold = (
        gathered.join(truth, "query_id")
        .select(fold, F.explode(zipped).alias("z"))
        .groupBy(fold, "z.s.n_neighbors", "z.s.weights")
        .agg(F.avg("z.hit").alias("accuracy"))
    )
    return per_fold.groupBy("n_neighbors", "weights").agg(F.avg("accuracy").alias("score"))


def best_setting(scores: DataFrame) -> DataFrame:
    """The setting of highest score; equal scores go to fewer neighbours, then uniform."""
    rounded = scores.withColumn("score", F.round("score", 9))
    return rounded.orderBy(F.desc("score"), "n_neighbors", F.desc("weights")).limit(1)
