from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import evaluate, neighbors
from sluice.operators.folds import numbered_in_groups, stratified_folds

SCHEMA = "id long, vector array<double>, label double, grp long"


def points(n: int, seed: int, clusters: int = 5):
    """Clustered points with some exact copies, a third of all rows in one cluster."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 10, size=(clusters, 3))
    place = np.where(np.arange(n) % 3 == 0, 0, rng.integers(0, clusters, n))
    vectors = centres[place] + rng.normal(0, 1, size=(n, 3))
    vectors[1::17] = vectors[0]
    return [(i, [float(x) for x in v], float(place[i] % 3), i % 4) for i, v in enumerate(vectors)]


def brute_force(queries, train, k, apart):
    found = {}
    for q in queries:
        near = sorted(
            (float(np.linalg.norm(np.array(q[1]) - np.array(t[1]))), t[0])
            for t in train
            if t[apart] != q[apart]
        )[:k]
        found[q[0]] = [(i, round(d, 9)) for d, i in near]
    return found


def as_lists(df):
    found: dict[int, list] = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.neighbor_id, round(r.distance, 9)))
    return found


@pytest.mark.parametrize(("apart", "column"), [("id", 0), ("grp", 3)])
@pytest.mark.parametrize(
    "sizes",
    [{}, {"broadcast_values": 0, "chunk_rows": 20, "cells": 6}, {"broadcast_values": 0, "cells": 1}],
)
def test_neighbors_equal_brute_force(spark, apart, column, sizes):
    rows = points(180, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    got = as_lists(neighbors.nearest_neighbors(df, df, 7, apart=apart, **sizes))
    assert got == brute_force(rows, rows, 7, column)


def test_fewer_rows_than_neighbors(spark):
    rows = points(5, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    for sizes in ({}, {"broadcast_values": 0, "chunk_rows": 2, "cells": 2}):
        got = as_lists(neighbors.nearest_neighbors(df, df, 9, **sizes))
        assert got == brute_force(rows, rows, 9, 0)


LISTS = [
    (1, 1, 10, 2.0, 0.0), (1, 2, 11, 1.0, 0.5), (1, 3, 12, 1.0, 0.5),
    (2, 1, 10, 3.0, 1.0), (2, 2, 11, 2.0, 1.0),
    (3, 1, 10, 5.0, 0.1), (3, 2, 11, 4.0, 1.0), (3, 3, 12, 4.0, 1.0),
]


def test_votes(spark):
    lists = spark.createDataFrame(
        LISTS, "query_id long, rank int, neighbor_id long, neighbor_label double, distance double"
    )
    uniform = {r.query_id: r.prediction for r in neighbors.vote(lists).collect()}
    weighted = {r.query_id: r.prediction for r in neighbors.vote(lists, "distance").collect()}
    assert uniform == {1: 1.0, 2: 2.0, 3: 4.0}
    assert weighted == {1: 2.0, 2: 2.0, 3: 5.0}
    with pytest.raises(ValueError):
        neighbors.vote(lists, "other")


def test_folds_are_even_and_equal_one_numbering(spark):
    rows = [(i, "big" if i % 3 else "small") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, label string")
    folds = stratified_folds(df)
    sizes = folds.groupBy("label", "fold").count().groupBy("label").agg(
        F.max("count").alias("most"), F.min("count").alias("least"), F.count("*").alias("folds")
    )
    assert all(r.most - r.least <= 1 and r.folds == 10 for r in sizes.collect())
    assert folds.count() == 500
    for digits in (1, 3):
        numbers = numbered_in_groups(df, "label", "id", digits)
        assert {(r.id, r.number) for r in numbers.collect()} == {
            (r.id, r.number) for r in numbered_in_groups(df, "label", "id").collect()
        }


PREDICTIONS = [(0, 0), (0, 0), (0, 1), (1, 0), (2, 0), (2, 3)]


def test_reports_with_empty_classes(spark):
    df = spark.createDataFrame(PREDICTIONS, "label int, prediction int")
    assert evaluate.accuracy(df).first().accuracy == pytest.approx(2 / 6)
    report = {r.label: tuple(r)[1:] for r in evaluate.class_report(df).collect()}
    assert report[0] == pytest.approx((0.5, 2 / 3, 4 / 7, 3))
    assert report[1] == (0, 0, 0, 1) and report[2] == (0, 0, 0, 2) and report[3] == (0, 0, 0, 0)
    assert report[None] == pytest.approx((0.25, 1 / 3, 2 / 7, 6))
    classes = evaluate.classes_of(df)
    assert classes == [0, 1, 2, 3]
    wide = [tuple(r) for r in evaluate.confusion_wide(df, classes).collect()]
    assert wide == [(0, 2, 1, 0, 0), (1, 1, 0, 0, 0), (2, 1, 0, 0, 1), (3, 0, 0, 0, 0)]
    assert evaluate.confusion(df).agg(F.sum("n")).first()[0] == len(PREDICTIONS)
