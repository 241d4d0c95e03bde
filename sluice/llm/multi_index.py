"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned by iterative quantisation on a bounded sample turns vectors into binary codes.
A code is cut into substrings, each with an index of its own.  If two codes differ in at most r bits,
one of their m substrings differs in at most floor(r / m), so that probing each index within that
radius meets every code within r.  What it meets is checked on the whole code and ranked by
the exact inner product of the original vectors.  The radius is the one that holds a set share
of the true neighbours of sampled queries, found by brute force over all rows.

For inner products of vectors of unlike length, a coordinate is added that gives all rows the
largest length, and 0 to queries; the cosine to the longer vectors then orders like the product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.batches import scan_partitions, stored

BITS = 128
WIDTH = 16
SAMPLE = 20_000
TUNING_QUERIES = 256
NEIGHBOURS = 20
SHARE = 0.98
ROUNDS = 30
QUERY_BLOCK = 20_000
BLOCK = 50_000
AT_ONCE = 64


def is_vector(column: Column) -> Column:
    """Vectors without null or non-finite components that are not all zero."""
    doubles = F.coalesce(column.cast("array<double>"), F.array().cast("array<double>"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(doubles, lambda x: x != 0.0)


def matrix_of(batch: pa.RecordBatch | pa.Table, column: str = "vector") -> np.ndarray:
    """The vectors of a batch as rows of doubles."""
    values = batch.column(column)
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(batch.num_rows, -1)


@dataclass(frozen=True)
class Coder:
    """Centre, rotation and the largest length of the indexed vectors."""

    centre: np.ndarray
    rotation: np.ndarray
    longest: float

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0.0))
        return self._codes(np.concatenate([vectors, extra[:, None]], axis=1) / self.longest)

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        return self._codes(np.concatenate([vectors / lengths, np.zeros((len(vectors), 1))], axis=1))

    def _codes(self, points: np.ndarray) -> np.ndarray:
        """Codes as WIDTH-bit substrings, a column each."""
        bits = (points - self.centre) @ self.rotation > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u2")


def learn_coder(sample: np.ndarray, longest: float, bits: int = BITS) -> Coder:
    """Iterative quantisation: rotate the principal directions towards the corners of a cube.

    With more bits than directions, further rotations of the same points are added.
    """
    extra = np.sqrt(np.maximum(longest**2 - (sample**2).sum(axis=1), 0.0))
    points = np.concatenate([sample, extra[:, None]], axis=1) / longest
    centre = points.mean(axis=0)
    points = points - centre
    rng = np.random.default_rng(7)
    values, vectors = np.linalg.eigh(points.T @ points)
    directions = vectors[:, np.argsort(-values)]
    parts, left = [], bits
    while left > 0:
        own = directions[:, : min(left, points.shape[1])]
        projected = points @ own
        rotation = np.linalg.qr(rng.standard_normal((own.shape[1], own.shape[1])))[0]
        for _ in range(ROUNDS):
            signs = np.where(projected @ rotation > 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(signs.T @ projected)
            rotation = (u @ vt).T
        parts.append(own @ rotation)
        left -= own.shape[1]
    return Coder(centre, np.concatenate(parts, axis=1), longest)


class Index:
    """The substring indexes of a block of rows: for each value the rows that have it."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.order, self.values, self.starts = [], [], []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, starts = np.unique(column[order], return_index=True)
            self.order.append(order)
            self.values.append(values)
            self.starts.append(np.append(starts, len(column)))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code differs from ``code`` in at most ``radius`` bits.

        The values of an index within its radius are picked from its directory, which is shorter
        than the list of all values of a ball.
        """
        each = radius // len(code)
        seen = np.zeros(len(self.codes), bool)
        for j, part in enumerate(code):
            near = np.flatnonzero(np.bitwise_count(self.values[j] ^ part) <= each)
            starts, ends = self.starts[j][near], self.starts[j][near + 1]
            sizes = ends - starts
            if sizes.sum():
                at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                seen[self.order[j][at]] = True
        found = np.flatnonzero(seen)
        distance = np.bitwise_count(self.codes[found] ^ code).sum(axis=1)
        return found[distance <= radius]


def _best(ids: np.ndarray, points: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k largest inner products, ties by smaller id.

    A matrix product picks them with some slack; their scores are summed row by row alike, so
    that equal vectors have equal scores.
    """
    rough = points @ query
    chosen = np.arange(len(rough))
    if len(rough) > k:
        least = np.partition(rough, len(rough) - k)[len(rough) - k]
        slack = 1e-9 * max(1.0, float(np.abs(rough).max()))
        chosen = np.flatnonzero(rough >= least - slack)
    scores = (points[chosen] * query).sum(axis=1)
    order = np.lexsort((ids[chosen], -scores))[:k]
    return chosen[order], scores[order]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def _pairs(queries: np.ndarray, ranks: list[np.ndarray], ids: np.ndarray, scores: list[np.ndarray]) -> pa.RecordBatch:
    sizes = [len(r) for r in ranks]
    flat = np.concatenate([*ranks, np.zeros(0, np.int64)]).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(queries, sizes)), pa.array(ids[flat]),
            pa.array(np.concatenate([*scores, np.zeros(0)])),
        ],
        ["query_id", "vec_id", "score"],
    )


PAIR_SCHEMA = "query_id long, vec_id long, score double"


def _scan(rows: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int, coder: Coder | None, radius: int) -> DataFrame:
    """The k best rows of each partition for each query: by the index, or of all rows without a coder."""
    held = rows.sparkSession.sparkContext.broadcast((query_ids, queries, coder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, vectors, own = held.value
        codes = None if own is None else own.queries(vectors)
        for table in _blocks(batches):
            ids, points = table.column("vec_id").to_numpy(), matrix_of(table)
            index = None if own is None else Index(own.rows(points))
            for start in range(0, len(numbers), AT_ONCE):
                ranks, scores = [], []
                for q in range(start, min(start + AT_ONCE, len(numbers))):
                    found = np.arange(len(ids)) if index is None else index.within(codes[q], radius)
                    found = found[ids[found] != numbers[q]]
                    best, products = _best(ids[found], points[found], vectors[q], k)
                    ranks.append(found[best])
                    scores.append(products)
                yield _pairs(numbers[start : start + AT_ONCE], ranks, ids, scores)

    return rows.mapInArrow(run, PAIR_SCHEMA)


def _merged(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _query_blocks(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries in blocks of about QUERY_BLOCK, dealt by a hash; the driver holds one at a time."""
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    for i in range(blocks):
        part = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i) if blocks > 1 else queries
        table = part.select("vec_id", "vector").toArrow()
        if table.num_rows:
            yield table.column("vec_id").to_numpy(), matrix_of(table)


def tune_radius(rows: DataFrame, queries: DataFrame, coder: Coder, k: int, share: float) -> int:
    """The radius that holds ``share`` of the true neighbours of sampled queries over all rows."""
    one_in = max(1, queries.count() // TUNING_QUERIES)
    table = (
        queries.filter(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(one_in)) == 0)
        .orderBy(F.xxhash64("vec_id")).limit(TUNING_QUERIES).select("vec_id", "vector").toArrow()
    )
    if not table.num_rows:
        return coder.rotation.shape[1]
    ids, vectors = table.column("vec_id").to_numpy(), matrix_of(table)
    best = _merged(_scan(rows, ids, vectors, k, None, 0), k)
    found = best.join(rows, "vec_id").select("query_id", "vector").toArrow()
    if not found.num_rows:
        return coder.rotation.shape[1]
    at = {int(q): i for i, q in enumerate(ids)}
    own = coder.queries(vectors)[[at[int(q)] for q in found.column("query_id").to_numpy()]]
    distance = np.bitwise_count(coder.rows(matrix_of(found)) ^ own).sum(axis=1)
    return int(np.quantile(distance, share, method="higher"))


def nearest_vectors(
    vectors: DataFrame,
    queries: Column,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = NEIGHBOURS,
    bits: int = BITS,
    share: float = SHARE,
    sample: int = SAMPLE,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest rows of each query among all other rows.

    ``queries`` says which rows are queries.  Nearest is the largest inner product of the original vectors
    in double precision; ties go to the smaller id.  Every row is in the index; a query for
    which it gives fewer than k rows is answered by brute force.  Each block of queries passes
    over the rows once, and each partition sends its k best of a query.

    Null vectors, zero ones, those with null or non-finite components, those of another width than most
    and rows with a null id take no part.  Of rows with the same id one takes part.  An
    empty table gives no rows, and other columns are not looked at.
    """
    column = F.col(f"`{vector_column}`")
    valid = vectors.filter(is_vector(column) & F.col(f"`{id_column}`").isNotNull()).select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), column.cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("is_query"),
    )
    widths = valid.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    rows = valid.filter(F.size("vector") == (widths[0]["w"] if widths else 0))
    if not rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min(F.struct("vector", "is_query")).alias("r")).select("vec_id", "r.*")
    rows = stored(rows.select("vec_id", "vector", "is_query"), "vectors")
    asked = rows.filter("is_query").select("vec_id", "vector")
    rows = rows.select("vec_id", "vector")
    figures = rows.agg(
        F.count("*").alias("n"),
        F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).alias("longest"),
    ).first()
    n = figures["n"]
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fraction = F.lit(int(min(1.0, sample / n) * (1 << 20)))
    drawn = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < fraction).select("vector").toArrow()
    if not drawn.num_rows:
        drawn = rows.limit(1).select("vector").toArrow()
    coder = learn_coder(matrix_of(drawn), figures["longest"] * (1 + 1e-12), bits)
    radius = tune_radius(rows, asked, coder, k, share)
    found = None
    for ids, block in _query_blocks(asked):
        part = stored(_merged(_scan(rows, ids, block, k, coder, radius), k), "neighbours")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    complete = found.filter(F.col("rank") == min(k, n - 1)).select(F.col("query_id").alias("vec_id"))
    short = stored(asked.join(complete, "vec_id", "left_anti"), "short-queries")
    rest = [
        stored(_merged(_scan(rows, ids, block, k, None, 0), k), "neighbours")
        for ids, block in (_query_blocks(short) if n > 1 else [])
    ]
    if rest:
        found = found.join(short.withColumnRenamed("vec_id", "query_id"), "query_id", "left_anti").select(found.columns)
        for part in rest:
            found = found.unionAll(part)
    return found.select("query_id", "rank", "vec_id", "score")
