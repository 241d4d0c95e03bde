"""Registered queries on nearest neighbours, folds and hold-out reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import evaluate, neighbors
from sluice.operators.folds import stratified_folds as with_folds
from sluice.plans.registry import query
from sluice.plans.tables import table

K = 7
FOLDS = 10

FOLDED = f"""folded as (select vec_id, label, embedding::double[] as v,
  ((row_number() over (partition by label order by md5(vec_id::varchar), vec_id) - 1) % {FOLDS})::int
  as fold from embeddings)"""


def _near(k: int, apart: str) -> str:
    return f"""{FOLDED},
    near as (select q.vec_id as query_id, q.label as truth, q.fold, t.vec_id as neighbor_id,
      t.label as neighbor_label, list_distance(q.v, t.v) as distance,
      row_number() over (partition by q.vec_id order by list_distance(q.v, t.v), t.vec_id) as rank
      from folded q join folded t on q.{apart} <> t.{apart} qualify rank <= {k})"""


def _voted(weight: str) -> str:
    return f"""votes as (select query_id, truth, neighbor_label, round(sum({weight}), 9) as votes
      from (select *, min(distance) over (partition by query_id) as least from near)
      group by all),
    voted as (select query_id, truth as label, neighbor_label as prediction, votes from votes
      qualify row_number() over (partition by query_id order by votes desc, neighbor_label) = 1)"""


UNIFORM = "1.0"
BY_DISTANCE = (
    "case when least = 0 then (distance = 0)::int::double else 1 / nullif(distance, 0) end"
)


def _folded(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    return with_folds(vectors, "label", "vec_id", FOLDS)


def _neighbors(spark: SparkSession, sf: str, k: int = K) -> DataFrame:
    """Out-of-fold neighbours of every row."""
    rows = _folded(spark, sf)
    return neighbors.nearest_neighbors(rows, rows, k, "vec_id", "embedding", "label", "fold")


def _predicted(spark: SparkSession, sf: str, weights: str = "uniform") -> DataFrame:
    """Out-of-fold prediction of every row, next to its label."""
    voted = neighbors.vote(_neighbors(spark, sf), weights)
    truth = table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), "label")
    prediction = F.col("prediction").cast("int").alias("prediction")
    return voted.join(truth, "query_id").select("query_id", "label", prediction, "votes")


@query(f"with {FOLDED} select vec_id, label, fold from folded")
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return _folded(spark, sf).select("vec_id", "label", "fold")


@query(
    f"""select doc_id, quality, ((row_number() over (partition by quality
    order by md5(doc_id::varchar), doc_id) - 1) % {FOLDS})::int as fold from labels"""
)
def stratified_folds_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """Folds of a label of which one class holds most rows."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return with_folds(labels, "quality", "doc_id", FOLDS)


@query(
    f"""with {_near(K, "vec_id")} select query_id, rank, neighbor_id,
    neighbor_label::double as neighbor_label, round(distance, 6) as distance from near"""
)
def knn_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest other rows of every row."""
    rows = table(spark, sf, "embeddings")
    found = neighbors.nearest_neighbors(rows, rows, K, "vec_id", "embedding")
    return found.withColumn("distance", F.round("distance", 6))


@query(f"with {_near(K, 'fold')}, {_voted(UNIFORM)} select query_id, label, prediction, votes from voted")
def knn_predict(spark: SparkSession, sf: str) -> DataFrame:
    return _predicted(spark, sf)


@query(
    f"""with {_near(K, "fold")}, {_voted(BY_DISTANCE)}
    select query_id, label, prediction, round(votes, 6) as votes from voted"""
)
def knn_predict_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return _predicted(spark, sf, "distance").withColumn("votes", F.round("votes", 6))


SEARCH = f"""{_near(49, "fold")},
  shares as (select *, {BY_DISTANCE} as share from
    (select *, min(distance) over (partition by query_id) as least from near)),
  settings as (select unnest(range(1, 50))::int as n_neighbors),
  sums as (select n_neighbors, query_id, any_value(fold) as fold, any_value(truth) as truth,
    neighbor_label, count(*)::double as uniform, round(sum(share), 9) as weighted
    from shares join settings on rank <= n_neighbors group by n_neighbors, query_id, neighbor_label),
  both_votes as (select n_neighbors, 'uniform' as weights, query_id, fold, truth, neighbor_label,
      uniform as votes from sums
    union all select n_neighbors, 'distance', query_id, fold, truth, neighbor_label, weighted
      from sums),
  chosen as (select * from both_votes qualify row_number() over
    (partition by n_neighbors, weights, query_id order by votes desc, neighbor_label) = 1),
  per_fold as (select n_neighbors, weights, fold, avg((truth = neighbor_label)::int) as accuracy
    from chosen group by all),
  scores as (select n_neighbors, weights, avg(accuracy) as score from per_fold group by all)"""


@query(f"with {SEARCH} select n_neighbors, weights, round(score, 6) as score from scores")
def knn_search_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = neighbors.search_scores(_folded(spark, sf), 49, "vec_id", "embedding")
    return scores.withColumn("score", F.round("score", 6))


@query(
    f"""with {SEARCH} select n_neighbors, weights, round(score, 6) as score from scores
    order by round(scores.score, 9) desc, n_neighbors, weights desc limit 1"""
)
def knn_search_best(spark: SparkSession, sf: str) -> DataFrame:
    scores = neighbors.search_scores(_folded(spark, sf), 49, "vec_id", "embedding")
    return neighbors.best_setting(scores).withColumn("score", F.round("score", 6))


PREDICTED = f"{_near(K, 'fold')}, {_voted(UNIFORM)}"


@query(f"with {PREDICTED} select round(avg((label = prediction)::int), 6) as accuracy from voted")
def eval_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.accuracy(_predicted(spark, sf)).select(F.round("accuracy", 6).alias("accuracy"))


@query(
    f"""with {PREDICTED},
    marks as (select label as c, 1 as t, 0 as p, (label = prediction)::int as h from voted
      union all select prediction, 0, 1, 0 from voted),
    counts as (select c, sum(t) as t, sum(p) as p, sum(h) as h from marks group by c),
    ratios as (select c, coalesce(h / nullif(p, 0), 0) as precision,
      coalesce(h / nullif(t, 0), 0) as recall, t from counts),
    report as (select c as label, precision, recall, coalesce(2 * precision * recall
      / nullif(precision + recall, 0), 0) as f1, t::bigint as support from ratios)
    select label, round(precision, 6) as precision, round(recall, 6) as recall,
      round(f1, 6) as f1, support from report
    union all select null, round(sum(precision * support) / sum(support), 6),
      round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
      sum(support)::bigint from report"""
)
def eval_class_report(spark: SparkSession, sf: str) -> DataFrame:
    report = evaluate.class_report(_predicted(spark, sf))
    rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return report.select("label", *rounded, "support")


@query(f"with {PREDICTED} select label, prediction, count(*) as n from voted group by all")
def eval_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(_predicted(spark, sf))


@query(
    f"with {PREDICTED} select label, "
    + ", ".join(f"count_if(prediction = {c})::bigint as predicted_{c}" for c in range(10))
    + " from voted group by label order by label"
)
def eval_confusion_wide(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion_wide(_predicted(spark, sf), list(range(10)))
