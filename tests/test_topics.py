from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import similarity, tfidf
from sluice.plans.topic_job import TopicJob

WORDS = [f"w{i:02}" for i in range(40)]


def documents(spark, n: int = 60, seed: int = 5):
    """Word arrays with exact copies and near copies."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 == 1:
            tokens = rows[-1][1] if i % 2 else [*rows[-1][1], WORDS[i % 40]]
        else:
            tokens = [WORDS[int(x)] for x in rng.integers(0, 40, 12) ** 2 // 40]
        rows.append((i, tokens))
    return spark.createDataFrame(rows, "doc_id long, tokens array<string>")


SETTINGS = tfidf.TfidfSettings(min_df=0.0, max_df=1.0, n_max=2)


def test_weights_have_unit_length_and_equal_the_vectors(spark):
    docs = documents(spark)
    weights = tfidf.tfidf_weights(docs, settings=SETTINGS)
    norms = weights.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert len(norms) == 60 and all(r.n == pytest.approx(1) for r in norms)
    model = tfidf.tfidf_vectorizer(docs, settings=SETTINGS)
    terms = model.stages[0].vocabulary
    vectors = tfidf.tfidf_vectors(docs, settings=SETTINGS).collect()
    dense = {
        (r.doc_id, terms[i]): w
        for r in vectors
        for i, w in zip(r.features.indices, r.features.values, strict=True)
    }
    long = {(r.doc_id, r.term): r.weight for r in weights.collect()}
    assert dense.keys() == long.keys()
    assert all(dense[key] == pytest.approx(w) for key, w in long.items())


def test_bounds_and_cap_of_the_vocabulary(spark):
    docs = spark.createDataFrame(
        [(1, ["aa", "bb", "bb"]), (2, ["aa", "cc"]), (3, ["aa", "cc", "dd"])],
        "doc_id long, tokens array<string>",
    )
    settings = tfidf.TfidfSettings(min_df=0.3, max_df=0.7, max_features=2, n_max=1)
    stats = tfidf.term_statistics(tfidf.term_frequencies(docs, n_max=1))
    kept = [r.term for r in tfidf.tfidf_vocabulary(stats, docs, settings).collect()]
    assert kept == ["bb", "cc"]


@pytest.mark.parametrize("least", [0.2, 0.5, 0.9])
@pytest.mark.parametrize(("per_block", "broadcast"), [(5_000, 4_000_000), (4, 0)])
def test_pairs_equal_brute_force(spark, monkeypatch, least, per_block, broadcast):
    monkeypatch.setattr(similarity, "BROADCAST_ENTRIES", broadcast)
    weights = tfidf.tfidf_weights(documents(spark), settings=SETTINGS)
    vectors: dict[int, dict[str, float]] = {}
    for r in weights.collect():
        vectors.setdefault(r.doc_id, {})[r.term] = r.weight
    groups: dict[tuple, list[int]] = {}
    for doc, v in sorted(vectors.items()):
        groups.setdefault(tuple(sorted((t, round(w, 9)) for t, w in v.items())), []).append(doc)
    copies = {docs[0]: len(docs) for docs in groups.values()}
    expected = {}
    for a in copies:
        for b in copies:
            dot = sum(w * vectors[b].get(t, 0) for t, w in vectors[a].items())
            if a < b and dot >= least:
                expected[a, b] = (copies[a], copies[b], round(dot, 9))
    found = {
        (r.doc_a, r.doc_b): (r.copies_a, r.copies_b, round(r.similarity, 9))
        for r in similarity.cosine_pairs(weights, least, per_block=per_block).collect()
    }
    assert found == expected and found


def test_similarity_limit_is_checked(spark):
    with pytest.raises(ValueError):
        similarity.cosine_pairs(documents(spark), 0)


TEXTS = {
    "pets": "the cat chases cats and dogs while another dog sleeps",
    "food": "fresh bread with butter and cheese for breakfast breads",
}


def test_topic_job_parts_the_texts(spark):
    rows = [
        (i, TEXTS["pets" if i % 2 else "food"] + f" {WORDS[i]}", float(i % 8)) for i in range(40)
    ] + [(98, None, 1.0), (99, TEXTS["pets"], None)]
    texts = spark.createDataFrame(rows, "doc_id long, text string, ltr double")
    job = TopicJob(texts, max_score=6, k=2, n_init=2)
    clusters = {r.doc_id: r.cluster for r in job.clusters.collect()}
    scored = [i for i in range(40) if i % 8 <= 6]
    assert sorted(clusters) == scored
    assert len({clusters[i] for i in scored if i % 2}) == 1
    assert clusters[0] != clusters[1]
    assert sum(r.n for r in job.sizes.collect()) == len(scored)
    assert {r.most for r in job.scores.collect()} <= {5.0, 6.0}
    assert job.top_terms.groupBy("cluster").count().agg(F.max("count")).first()[0] == 10
    places = job.map.collect()
    assert len(places) == len(scored)
    assert all(math.isfinite(r.x) and math.isfinite(r.y) for r in places)
