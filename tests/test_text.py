from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluice.functions.stem import english_stem, suffix_stem
from sluice.functions.text import (
    clean_text,
    iso_to_timestamp,
    text_words,
    without_stop_words,
    word_ngrams,
    word_tokens,
)
from sluice.operators import words


def value(spark, column, **cells):
    row = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{c} string" for c in cells))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "cleaned"),
    [
        ("a,b", "ab"),
        ("Don't STOP", "dont stop"),
        ("x:y", "x:y"),
        ("né 12", "n "),
        ("a b c", "abc"),
        ("", ""),
        ("123", ""),
    ],
)
def test_cleaning_deletes_other_characters(spark, text, cleaned):
    assert value(spark, clean_text(F.col("t")), t=text) == cleaned


def test_cleaning_options(spark):
    t = F.col("t")
    assert value(spark, clean_text(t, unicode_space=True), t="a b") == "a b"
    assert value(spark, clean_text(t, keep_letters=r"\p{L}"), t="Né1") == "né"
    assert value(spark, clean_text(t, ["farm", "sure"]), t="Farmers insured") == "ers ind"


def test_words_split_at_colons_and_fused_words(spark):
    tokens = value(spark, word_tokens(F.col("t")), t="x:y cannot  gonna wannabe")
    assert tokens == ["x", "y", "can", "not", "gon", "na", "wannabe"]


def test_stop_words_keep_repeats_and_miss_joined_ones(spark):
    tokens = value(spark, text_words(F.col("t")), t="The dog, the dog don't")
    assert tokens == ["dog", "dog", "dont"]
    assert value(spark, without_stop_words(F.array(F.lit("a")), []), t="") == ["a"]


def test_ngrams_skip_short_words(spark):
    grams = value(spark, word_ngrams(F.split("t", " "), 1, 3), t="aa b cc dd")
    assert grams == ["aa", "cc", "dd", "aa cc", "cc dd", "aa cc dd"]
    assert value(spark, word_ngrams(F.split("t", " "), 2, 3), t="aa") == []


# published pairs of the English rules
STEMS = {
    "consign": "consign", "consigned": "consign", "consistency": "consist", "knightly": "knight",
    "knots": "knot", "generously": "generous", "ties": "tie", "cries": "cri", "gas": "gas",
    "gaps": "gap", "kiwis": "kiwi", "hoped": "hope", "hopping": "hop", "luxuriated": "luxuri",
    "agreed": "agre", "feed": "feed", "happy": "happi", "say": "say", "by": "by", "skies": "sky",
    "dying": "die", "relational": "relat", "conditional": "condit", "rationalize": "ration",
    "hopefulness": "hope", "adoption": "adopt", "controlling": "control", "rolling": "roll",
    "communication": "communic", "arsenal": "arsenal", "electricity": "electr", "youth": "youth",
    "succeeding": "succeed", "apology": "apolog", "quickly": "quick", "bee": "bee",
    "formative": "format", "probate": "probat", "cease": "ceas", "controller": "control",
}


def test_english_stems(spark):
    rows = spark.createDataFrame([(w,) for w in STEMS], "w string")
    found = {r.w: r.s for r in rows.select("w", english_stem(F.col("w")).alias("s")).collect()}
    assert found == STEMS


def test_stem_map_prefers_frequent_then_least_word(spark):
    docs = spark.createDataFrame(
        [(1, ["cats", "cats", "cat", "dogs", "dog", "x"]), (2, [])],
        "doc_id long, tokens array<string>",
    )
    vocab = words.stem_vocabulary(docs, stemmer=suffix_stem())
    best = {r.stem: r.orig for r in words.stem_representatives(vocab).collect()}
    assert best == {"cat": "cats", "dog": "dog", "x": "x"}
    tied = words.stem_maxima(vocab).filter("stem = 'dog'").count()
    assert tied == 2
    restored = words.canonical_tokens(docs, stemmer=suffix_stem())
    assert {r.doc_id: r.tokens for r in restored.collect()} == {
        1: ["cats", "cats", "cats", "dog", "dog", "x"],
        2: [],
    }


def test_iso_timestamps(spark):
    stamp = value(spark, iso_to_timestamp(F.col("t")).cast("string"), t="2020-01-02T03:04:05")
    assert stamp == "2020-01-02 03:04:05"
    assert value(spark, iso_to_timestamp(F.col("t")), t="never") is None
