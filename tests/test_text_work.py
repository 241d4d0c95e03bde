"""What the text side reads and holds."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.functions.text import text_words, word_ngrams
from sluice.operators import similarity, tfidf
from sluice.operators import words as corpus
from sluice.plans import model_queries


@pytest.mark.parametrize("sizes", [(1, 1), (1, 3), (2, 3), (3, 3)])
def test_rows_of_runs_are_the_runs_of_the_arrays(spark, sizes):
    words = [["aa", "b", "cc", "dd", "aa", "b", "cc"], ["aa"], ["aa", "bb"], [], None, ["x", "yy", None, "zz"], ["aa"] * 4]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, tokens array<string>")
    wanted = docs.select("doc_id", F.explode(word_ngrams(F.col("tokens"), *sizes)).alias("term"))
    found = tfidf.gram_rows(docs, "doc_id", n_min=sizes[0], n_max=sizes[1])
    assert found.columns == ["doc_id", "term"]
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, wanted.collect()))


def test_weights_are_made_once_for_the_vectors(spark):
    rows = [(d, t, 0.5 + d % 3) for d in range(40) for t in ("aa", "bb", f"t{d % 5}")]
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)

    weights = spark.createDataFrame(rows, "doc_id long, term string, weight double").mapInArrow(count, "doc_id long, term string, weight double")
    groups = similarity.copy_groups(similarity.document_vectors(weights)).collect()
    assert len(groups) == 40 and {r.copies for r in groups} == {2, 3}
    assert made.value == len(rows)


def test_words_of_a_text_are_made_once(spark):
    text = F.concat_ws(" ", F.lit("Aa, bb"), F.col("id").cast("string"))
    docs = spark.range(4).select("id", F.when(F.col("id") > 1, text).when(F.col("id") == 1, "").alias("text"))
    made = docs.select(F.col("id").alias("doc_id"), F.lit("x").alias("source"), text_words(F.col("text")).alias("tokens"))
    every = {
        "words": corpus.corpus_words(made), "top": corpus.top_words(made, "source"),
        "rows": tfidf.gram_rows(made, "doc_id", n_max=2), "stems": corpus.stem_vocabulary(made),
    }
    for name, found in every.items():
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") == 1, name
    assert Counter(r.word for r in every["words"].collect()) == {"aa": 2, "bb": 2}
    assert Counter(r.term for r in every["rows"].collect()) == {"aa": 2, "bb": 2, "aa bb": 2}


def test_null_and_empty_arrays_have_no_words(spark):
    docs = spark.createDataFrame([(1, ["a", None, "a"]), (2, []), (3, None)], "doc_id long, tokens array<string>")
    assert Counter(r.word for r in corpus.corpus_words(docs).collect()) == {"a": 2, None: 1}


def test_words_behind_examples_are_made_once(spark, sf_dir, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    rows = [(i, "de" if i % 3 else "en", ["aa", "bb", f"w{i % 4}"]) for i in range(60)]

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    schema = "doc_id long, lang string, tokens array<string>"
    monkeypatch.setattr(model_queries, "tokenised", lambda *_: spark.createDataFrame(rows, schema).mapInArrow(counted, schema))
    found = model_queries.examples(spark, sf_dir).collect()
    assert made.value == len(rows) == len({r.id for r in found})
    assert {r.id: r.label for r in found} == {i: float(lang == "en") for i, lang, _ in rows}


def test_a_task_counts_the_terms_of_a_bounded_number_of_words(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "WORDS_PER_TASK", 100, raising=False)
    rows = [(i % 1900 if i % 40 else None, ["aa", "bb", "aa", f"w{i % 7}"]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    found = tfidf.term_frequencies(docs, n_max=1).withColumn("task", F.spark_partition_id()).collect()
    wanted = Counter((d, t) for d, words in rows for t in words)
    assert {(r.doc_id, r.term): r.tf for r in found} == wanted and len(found) == len(wanted)
    # rows without an id are a document, which is not parted
    held = Counter()
    for r in found:
        held[r.task] += r.tf if r.doc_id is not None else 0
    assert max(held.values()) < 300
