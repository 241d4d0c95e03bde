"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text, lowered and stripped of punctuation, and their
beginnings of four to six characters.  Labels only say toxic or not; the grades 1 … 3 of toxic texts are
the thirds of the number of their distinct words that carry a telling feature.  One weight vector
serves all thresholds: P(grade >= k) = sigmoid(w x - t_k) with t_1 < t_2 < t_3.  The
output is the expected grade.

The fit takes a bounded sample of labelled rows.  Spark counts the features of the sample and keeps
those that toxic and other texts differ in; only these, and the few of them in each sampled
text, reach the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from sluice.llm.batches import slices, stored, texts_of

SAMPLE = 20_000
GRADES = 3
BEGINNINGS = (4, 5, 6)
LEAST_DOCS = 4
LEAST_Z = 7.0
TELLING = 0.9
PENALTY = 2e-5
STEPS = 1500
CACHED = 200_000
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|/\\`~_-+=«»“”„’…¡¿"


def features_of(token: str) -> list[str]:
    """A word and its beginnings; the latter end in a hyphen."""
    word = token.strip(PUNCTUATION)
    if not word:
        return []
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


def tokens_of(text: str) -> list[str]:
    return text.lower().split()


@dataclass
class Model:
    """Weights of features and thresholds of grades."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES, np.inf))

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


class Scorer(dict):
    """The summed weights of a token's features, remembered for a bounded number of tokens."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.weights = model.weights

    def __missing__(self, token: str) -> float:
        if len(self) >= CACHED:
            self.clear()
        get = self.weights.get
        value = self[token] = sum(get(f, 0.0) for f in features_of(token))
        return value

    def of(self, texts: list[str]) -> np.ndarray:
        return np.array([sum(map(self.__getitem__, set(tokens_of(t)))) for t in texts], float)


def fit_ordinal(
    rows: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, width: int, levels: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of a cumulative-link model with logistic links.

    Full-batch Adam on the mean log-likelihood with an L2 penalty.  Thresholds are a first
    one and positive steps.
    """
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    value = np.concatenate([*values, np.zeros(0)]).astype(float)
    n = len(grades)
    params = np.zeros(width + levels)
    params[width] = 2.0
    first, second = np.zeros_like(params), np.zeros_like(params)

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    for step in range(1, STEPS + 1):
        w, raw = params[:width], params[width:]
        cuts = raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:]))))
        score = np.bincount(row, weights=value * w[column], minlength=n)
        # P(y = k) = s(score - cut_k) - s(score - cut_{k+1}), with cut_0 = -inf and cut_{L+1} = inf.
        low = np.where(grades > 0, cuts[np.maximum(grades, 1) - 1], -np.inf)
        high = np.where(grades < levels, cuts[np.minimum(grades, levels - 1)], np.inf)
        a, b = sigmoid(score - low), sigmoid(score - high)
        likely = np.maximum(a - b, 1e-12)
        da, db = a * (1 - a) / likely, b * (1 - b) / likely
        g_score = -(da - db) / n
        g_cut = np.zeros(levels)
        np.add.at(g_cut, np.maximum(grades, 1) - 1, np.where(grades > 0, da, 0.0) / n)
        np.add.at(g_cut, np.minimum(grades, levels - 1), np.where(grades < levels, -db, 0.0) / n)
        g_raw = np.concatenate(([g_cut.sum()], np.cumsum(g_cut[::-1])[::-1][1:] * np.exp(raw[1:])))
        g_w = np.bincount(column, weights=value * g_score[row], minlength=width) + PENALTY * w
        gradient = np.concatenate((g_w, g_raw))
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        rate = 0.05 * (1 - step / STEPS) + 1e-4
        params -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    raw = params[width:]
    return params[:width], raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:]))))


def sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``(text, toxic)`` of up to about ``sample`` labelled rows, chosen by a hash of their ids."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if total > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(sample / total * (1 << 20))))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", (F.col("toxic") > 0).alias("toxic"))


def without_copies(rows: DataFrame) -> DataFrame:
    """``(text, toxic)`` with one of the texts that share a least shingle hash, twice over.

    Copies of a toxic text would make all of its words look toxic.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            least = [_least_hashes(t) for t in texts_of(batch, "text")]
            marks = [pa.array([x[i] for x in least], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *marks], ["text", "toxic", "a", "b"])

    out = rows.mapInArrow(run, "text string, toxic boolean, a long, b long")
    for mark in ("a", "b"):
        one = out.groupBy(mark).agg(F.min(F.struct("text", "toxic", "a", "b")).alias("one"))
        out = one.select("one.*")
    return out.select("text", "toxic")


def _least_hashes(text: str) -> tuple[int, int]:
    words = tokens_of(text)
    found = [xxhash.xxh3_64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))]
    return min(found) >> 1, min((h * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF for h in found) >> 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit the model on labelled documents: ``docs`` (doc_id, text), ``labels`` (doc_id, toxic).

    Null ids and labels, and labels of no document, take no part; a null text counts as empty.  Of labels of the same id
    the largest counts, and each row of a repeated id is one more text before copies are left out.  Without labelled texts
    the model calls nothing toxic.  Other columns, also those named like a label, are not looked at.
    """
    rows = stored(without_copies(sampled(docs, labels, sample)), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in slices(batches):
            for text, toxic in zip(texts_of(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
                found[toxic].update({f for t in set(tokens_of(text)) for f in features_of(t)})
        names = list(found[0] | found[1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([found[True][x] for x in names], pa.int64()),
                pa.array([found[False][x] for x in names], pa.int64()),
            ],
            ["feature", "toxic", "other"],
        )

    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    if not n1 or not n0:
        return Model()
    share = n1 / (n1 + n0)
    seen = F.col("toxic") + F.col("other")
    z = (F.col("toxic") - seen * share) / F.sqrt(seen * share * (1 - share))
    counts = (
        rows.mapInArrow(count, "feature string, toxic long, other long")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .filter((seen >= LEAST_DOCS) & ((z >= LEAST_Z) | (z <= -LEAST_Z)))
        .orderBy("feature").collect()
    )
    number = {r["feature"]: i for i, r in enumerate(counts)}
    telling = {r["feature"] for r in counts if r["toxic"] >= TELLING * (r["toxic"] + r["other"])}

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, marks = [], []
            for text in texts_of(batch, "text"):
                tokens = tokens_of(text)
                own = Counter(number[f] for t in set(tokens) for f in features_of(t) if f in number)
                found.append((list(own), [float(x) for x in own.values()]))
                marks.append(float(sum(any(f in telling for f in features_of(t)) for t in set(tokens))))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f for f, _ in found], pa.list_(pa.int32())),
                    pa.array([v for _, v in found], pa.list_(pa.float64())),
                    pa.array(marks, pa.float64()),
                    batch.column("toxic"),
                ],
                ["features", "times", "marks", "toxic"],
            )

    schema = "features array<int>, times array<double>, marks double, toxic boolean"
    sample_rows = rows.mapInArrow(pick, schema).collect()
    toxic = np.array([r["toxic"] for r in sample_rows])
    marks = np.array([r["marks"] for r in sample_rows])
    marked = marks[toxic & (marks > 0)]
    bounds = np.quantile(marked, np.arange(1, GRADES) / GRADES) if len(marked) else np.ones(GRADES - 1)
    grades = np.where(toxic, 1 + np.searchsorted(bounds, marks, side="left"), 0)
    weights, thresholds = fit_ordinal(
        [np.array(r["features"], np.int64) for r in sample_rows],
        [np.array(r["times"], float) for r in sample_rows], grades, len(number), GRADES,
    )
    return Model({f: float(weights[i]) for f, i in number.items() if weights[i]}, thresholds)


def severity(docs: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, severity, grade, p_toxic, toxic)`` of each document.

    ``severity`` is the expected grade from 0 to 3, ``grade`` the likeliest one, ``p_toxic`` the
    probability of any but 0, and ``toxic`` says whether that is a half or more.  A null text
    counts as empty.  Null ids and repeated rows stay as they are, an empty table gives
    no rows, and other columns are not looked at.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in slices(batches):
            least = held.value.at_least(scorer.of(texts_of(batch, "text")))
            each = -np.diff(np.concatenate([np.ones((len(least), 1)), least, np.zeros((len(least), 1))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(least.sum(axis=1)), pa.array(each.argmax(axis=1)),
                    pa.array(least[:, 0]), pa.array(least[:, 0] >= 0.5),
                ],
                ["doc_id", "severity", "grade", "p_toxic", "toxic"],
            )

    schema = StructType(
        [
            StructField("doc_id", LongType()), StructField("severity", DoubleType()), StructField("grade", LongType()),
            StructField("p_toxic", DoubleType()), StructField("toxic", BooleanType()),
        ]
    )
    narrow = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"`{text_column}` as text")
    return narrow.mapInArrow(run, schema)


def keep_civil(docs: DataFrame, model: Model, *, text_column: str = "text") -> DataFrame:
    """The documents that are not toxic, with all their columns.

    A null text counts as empty.  Null ids stay as they are, repeated rows stay or go together, an empty table stays
    empty, and columns of any other name are passed on.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in slices(batches):
            least = held.value.at_least(scorer.of(texts_of(batch, text_column)))
            yield batch.filter(pa.array(least[:, 0] < 0.5))

    return docs.mapInArrow(run, docs.schema)
