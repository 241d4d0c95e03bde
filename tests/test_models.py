from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sluice.operators import kernel, neighbors
from sluice.operators.boosting import AdaBoost
from sluice.operators.folds import stratified_folds
from sluice.operators.search import sample_settings
from sluice.plans import classify


def test_settings_are_drawn_without_repeat():
    drawn = sample_settings(classify.BOOST_SPACE, 15, seed=7)
    assert len({tuple(s.values()) for s in drawn}) == 15
    assert drawn == sample_settings(classify.BOOST_SPACE, 15, seed=7)
    assert len(sample_settings({"a": [1, 2], "b": [1]}, 10)) == 2


@pytest.fixture(scope="module")
def rings(spark):
    """Three classes by distance from the origin, which no straight line parts."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        angle, radius = rng.uniform(0, 2 * np.pi), (i % 3) * 2 + rng.uniform(0.2, 1.2)
        x = [float(radius * np.cos(angle)), float(radius * np.sin(angle))]
        rows.append((i, float(i % 3), x, Vectors.dense(x)))
    df = spark.createDataFrame(rows, ["id", "label", "vector", "features"])
    df = stratified_folds(df).checkpoint()
    return df.filter("fold > 1").drop("fold"), df.filter("fold < 2").drop("fold")


def share_right(report) -> float:
    return report.accuracy.first().accuracy


@pytest.mark.parametrize("algorithm", ["SAMME", "SAMME.R"])
def test_boosting_beats_one_tree(rings, algorithm):
    train, test = rings

    def right(rounds):
        model = AdaBoost(rounds=rounds, algorithm=algorithm, maxDepth=2, checkpointEvery=2).fit(train)
        hit = (F.col("label") == F.col("prediction")).cast("double")
        return model.transform(test).agg(F.avg(hit)).first()[0]

    assert right(6) > max(right(1), 0.7)


def test_boosting_stops_when_nothing_is_wrong(spark):
    rows = [(float(i % 2), Vectors.dense([float(i % 2)])) for i in range(20)]
    model = AdaBoost(rounds=5).fit(spark.createDataFrame(rows, ["label", "features"]))
    assert len(model.trees) == 1


def test_fourier_features_follow_the_kernel(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 4))
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["id", "features"])
    mapped = kernel.FourierFeatures(components=4000, gamma=0.3).transform(df).orderBy("id")
    z = np.array([r.fourier.toArray() for r in mapped.collect()])
    exact = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).max() < 0.1


def test_forest_job(rings):
    space = {"trees": [5, 10], "max_features": ["sqrt", "all"]}
    report = classify.forest_model(*rings, space=space, n_iter=2, folds=3, max_depth=6)
    assert share_right(report) > 0.85
    assert len(report.scores) == 2 and set(report.best) == {"trees", "max_features"}
    assert report.confusion.agg(F.sum("n")).first()[0] == rings[1].count()


def test_boost_job(rings):
    space = {"algorithm": ["SAMME"], "rounds": [3], "max_features": ["all"], "splitter": ["random"]}
    report = classify.boost_model(*rings, space=space, n_iter=1, folds=2, max_depth=3)
    assert share_right(report) > 0.7


def test_kernel_job(rings):
    report = classify.kernel_model(
        *rings, space={"penalty": [10]}, n_iter=1, folds=2, gamma=1.0, max_iter=20
    )
    assert share_right(report) > 0.85


def test_neighbor_job_and_scores(rings):
    train, test = rings
    report = classify.neighbor_model(train, test, n_iter=5, folds=4)
    assert share_right(report) > 0.9
    # the shared list must score a setting as a separate run with that setting does
    folded = stratified_folds(train, folds=4)
    scores = {(r.n_neighbors, r.weights): r.score for r in neighbors.search_scores(folded).collect()}
    for k, weights in ((1, "uniform"), (8, "uniform"), (8, "distance")):
        near = neighbors.nearest_neighbors(folded, folded, k, apart="fold")
        voted = neighbors.vote(near, weights).join(
            folded.select(F.col("id").alias("query_id"), "label", "fold"), "query_id"
        )
        hit = (F.col("label") == F.col("prediction")).cast("double")
        per_fold = voted.groupBy("fold").agg(F.avg(hit).alias("a"))
        assert scores[k, weights] == pytest.approx(per_fold.agg(F.avg("a")).first()[0])


def test_language_is_learnable(spark):
    from sluice.plans import model_queries

    train, test = model_queries.split(spark, "/root/testdata/sf0.01")
    hit = (F.col("label") == F.col("prediction")).cast("double")
    for job in (model_queries.forest_predictions, model_queries.boost_predictions, model_queries.machine_predictions):
        assert job(train, test).agg(F.avg(hit)).first()[0] >= 0.9, job.__name__


def test_fourier_features_of_sparse_rows(spark):
    rng = np.random.default_rng(4)
    x = np.where(rng.random((40, 5000)) < 0.01, rng.normal(size=(40, 5000)), 0.0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, Vectors.sparse(5000, [(int(j), float(v[j])) for j in np.flatnonzero(v)])) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", "features"]).repartition(3)
    mapped = kernel.FourierFeatures(components=4000, gamma=0.7).transform(df).orderBy("id")
    z = np.array([r.fourier.toArray() for r in mapped.collect()])
    exact = np.exp(-0.7 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).max() < 0.1
