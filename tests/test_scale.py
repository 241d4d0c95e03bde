"""Steps that must not move or hold more than their result needs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sluice.functions.text import clean_text, counted, word_ngrams
from sluice.operators import neighbors, similarity, tfidf, words


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def some_docs(spark):
    rng = random.Random(3)
    rows = [(i % 37, [rng.choice(["aa", "bb", "cc", f"w{rng.randrange(400)}"]) for _ in range(rng.randrange(0, 9))]) for i in range(80)]
    return spark.createDataFrame([*rows, (None, ["aa", "bb"]), (99, [])], "doc_id long, tokens array<string>")


def plain_frequencies(docs):
    return docs.select("doc_id", F.explode(word_ngrams(F.col("tokens"))).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def test_texts_are_cleaned_without_a_replacement_for_every_run(spark):
    texts = spark.createDataFrame([("a,b C-d: é\x0b1 x",), ("",), (",,",), (None,)], "t string")
    cleaned = texts.select(clean_text(F.col("t")).alias("c"))
    assert "regexp_replace" not in plan_of(cleaned)
    assert [r.c for r in cleaned.collect()] == ["ab cd: \x0b x", "", "", None]


def test_terms_are_counted_in_the_row(spark):
    row = spark.createDataFrame([(["b", "a", "b", "b"],), ([],)], "t array<string>").select(counted(F.col("t")).alias("c"))
    assert [[tuple(x) for x in r.c or []] for r in row.collect()] == [[("a", 1), ("b", 3)], []]


def test_frequencies_move_token_arrays_and_no_terms(spark):
    docs = some_docs(spark)
    found = tfidf.term_frequencies(docs)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain_frequencies(docs).collect()), key=str)
    assert not re.search(r"hashpartitioning\([^)]*term", plan_of(found))
    assert not re.search(r"Aggregate\(keys=\[[^\]]*term", plan_of(found))


def test_rare_terms_are_not_counted_one_by_one(spark):
    docs = some_docs(spark)
    grams = docs.select("doc_id", F.explode(word_ngrams(F.col("tokens"))).alias("term"))
    found = tfidf.frequent_statistics(grams, F.lit(5))
    wanted = tfidf.term_statistics(plain_frequencies(docs)).filter("df >= 5")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect())) != []
    assert "_bucket" in plan_of(tfidf.vocabulary_of(docs))


def test_maxima_read_the_vocabulary_once(spark):
    vocab = spark.createDataFrame([("run", "run", 3), ("runs", "run", 3), ("ran", "run", 1)], "orig string, stem string, n long")
    best = words.stem_maxima(vocab)
    assert "Join" not in plan_of(best)
    assert sorted(map(tuple, best.collect())) == [("run", "run", 3), ("runs", "run", 3)]


def test_lists_of_rows_that_come_in_parts_equal_brute_force():
    rng = np.random.default_rng(5)
    for spread in (1.0, 1e-3, 1e18):
        rows = (rng.normal(0, 1, (500, 8)) + 3.0) * spread
        rows[5::50] = rows[4]
        groups = [None if i % 91 == 7 else i % 3 for i in range(500)]
        table = pa.table({
            "id": pa.array(range(500), pa.int64()), "vector": pa.array(rows.tolist(), pa.list_(pa.float64())),
            "label": pa.array([None if i % 10 == 3 else float(i % 4) for i in range(500)]), "grp": pa.array(groups, pa.int64()),
        })
        lists = neighbors.NearestLists(table, 6)
        for start in (0, 3, 120, 400):
            lists.add(table.slice(start, {0: 3, 3: 117, 120: 280, 400: 100}[start]))
        away = np.sqrt(((rows[:, None] - rows[None]) ** 2).sum(axis=2))
        for i in range(500):
            others = [j for j in range(500) if groups[i] is None or groups[j] is None or groups[i] != groups[j]]
            wanted = sorted(others, key=lambda j: (away[i, j], j))[:6]
            assert lists.near[i].tolist() == wanted
    assert sum(b.num_rows for b in lists.batches(step=64)) == 3_000


def test_streamed_rows_give_the_lists_of_the_broadcast(spark):
    rng = np.random.default_rng(8)
    rows = [(i % 290 if i % 40 else None, rng.normal(0, 1, 4).tolist(), float(i % 3) if i % 7 else None, i % 4 if i % 11 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, vector array<float>, label double, grp long").repartition(3)
    key = ("query_id", "rank", "distance", "neighbor_label")
    lists = [
        sorted((tuple(r[c] for c in key) for r in neighbors.nearest_neighbors(df, df, 5, apart="grp", **sizes).collect()), key=str)
        for sizes in ({}, {"broadcast_values": 0, "chunk_rows": 40, "cells": 5})
    ]
    assert lists[0] == lists[1]


def test_training_rows_are_copied_for_tasks_and_not_for_chunks(spark, monkeypatch):
    """Lists of a query were sent for each chunk of the training rows: 60 of them here."""
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, rng.normal(0, 1, 3).tolist(), 0.0) for i in range(300)], "id long, vector array<double>, label double")
    kept = []
    streamed = neighbors._streamed
    monkeypatch.setattr(neighbors, "_streamed", lambda *args: kept.append(streamed(*args)) or kept[0])
    neighbors.nearest_neighbors(df, df, 3, broadcast_values=0, chunk_rows=5, cells=2).collect()
    assert kept[0].count() == 900


def test_words_are_restored_where_their_arrays_lie(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ["run", "runs", "cat"]), (2, ["runs", "run", "run"]), (3, []), (None, ["cats", "cat", "cat"])], "doc_id long, tokens array<string>")
    found = words.canonical_tokens(docs)
    assert not re.search(r"hashpartitioning\(word", plan_of(found))
    rows = sorted(map(tuple, found.collect()), key=str)
    monkeypatch.setattr(words, "BROADCAST_WORDS", 0)
    assert sorted(map(tuple, words.canonical_tokens(docs).collect()), key=str) == rows
    assert (2, ["run", "run", "run"]) in rows and (3, []) in rows


def test_similar_pairs_by_blocks_move_vectors_once_a_block(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(1000 - i, [rng.choice(["aa", "bb", "cc", "dd", "ee", "ff"]) for _ in range(rng.randrange(1, 12))]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    weights = tfidf.tfidf_weights(docs, settings=tfidf.TfidfSettings(max_df=1.0, n_max=1))
    found = []
    for entries in (4_000_000, 0):
        monkeypatch.setattr(similarity, "BROADCAST_ENTRIES", entries)
        monkeypatch.setattr(similarity, "BLOCK_DOCUMENTS", 9)
        pairs = similarity.cosine_pairs(weights, 0.7)
        found.append({tuple(r)[:4]: round(r.similarity, 9) for r in pairs.collect()})
    assert found[0] == found[1] and len(found[0]) > 20
    assert "Join" not in plan_of(pairs).split("FlatMapCoGroups")[0]
    assert "FlatMapCoGroupsInArrow" in plan_of(pairs)
