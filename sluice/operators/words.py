"""Corpus words, vocabulary and the map from stems back to real words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.bind import to_explode
from sluice.functions.stem import Stemmer, english_stem
from sluice.session import cut_lineage

# a lookup of up to this many words is sent to every task
BROADCAST_WORDS = 500_000


def corpus_words(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One row per word of every document, repeats included."""
    return docs.select(F.explode(to_explode(F.col(tokens))).alias("word"))


def vocabulary(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """The distinct words of the corpus."""
    return corpus_words(docs, tokens).distinct()


def word_counts(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Occurrences of each word; counted on the map side before the shuffle."""
    return corpus_words(docs, tokens).groupBy("word").agg(F.count("*").alias("n"))


def stem_vocabulary(
    docs: DataFrame, tokens: str = "tokens", stemmer: Stemmer = english_stem
) -> DataFrame:
    """Count of each word with its stem: ``(orig, stem, n)``."""
    counts = word_counts(docs, tokens)
    word = F.col("word")
    return counts.select(word.alias("orig"), stemmer(word).alias("stem"), "n")


def stem_maxima(vocab: DataFrame) -> DataFrame:
    """The words that are most frequent for their stem; ties are kept."""
    # a window makes the stems once, where a join with the maxima makes them for either side
    best = F.max("n").over(Window.partitionBy("stem"))
    return vocab.withColumn("_best", best).filter(F.col("n") == F.col("_best")).select("orig", "stem", "n")


def stem_representatives(vocab: DataFrame) -> DataFrame:
    """One word per stem: the most frequent, then the least in order."""
    best = F.min(F.struct((-F.col("n")).alias("n"), "orig"))
    return vocab.groupBy("stem").agg(best.alias("b")).select(
        "stem", F.col("b.orig").alias("orig"), (-F.col("b.n")).alias("n")
    )


def restored_words(vocab: DataFrame) -> DataFrame:
    """``(word, restored)`` for the words that another word of their stem stands for.

    Words that stand for themselves are left out, so this lookup is much smaller
    than the vocabulary and often fits a broadcast, which is decided at run time.
    """
    best = F.min(F.struct((-F.col("n")).alias("n"), "orig")).over(Window.partitionBy("stem"))
    return (
        vocab.withColumn("restored", best["orig"])
        .filter(F.col("orig") != F.col("restored"))
        .select(F.col("orig").alias("word"), "restored")
    )


def retranslate(
    docs: DataFrame, lookup: DataFrame, id_col: str = "doc_id", tokens: str = "tokens"
) -> DataFrame:
    """Replace each word by the word that stands for its stem, in place.

    The result is partitioned by ``id_col``, which later per-document steps
    reuse.  Documents without words come back with an empty array.
    """
    words = docs.select(id_col, F.posexplode_outer(tokens).alias("pos", "word"))
    restored = words.join(lookup, "word", "left").select(
        id_col, "pos", F.coalesce("restored", "word").alias("word")
    )
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "word"))
    return (
        restored.groupBy(id_col)
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select(id_col, F.col("entries.word").alias(tokens))
    )


def canonical_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    tokens: str = "tokens",
    stemmer: Stemmer = english_stem,
) -> DataFrame:
    """Documents with each word replaced by the commonest word of the same stem."""
    lookup = cut_lineage(restored_words(stem_vocabulary(docs, tokens, stemmer)))
    if lookup.limit(BROADCAST_WORDS + 1).count() > BROADCAST_WORDS:
        return retranslate(docs, lookup, id_col, tokens)
    # placed as arrays, the words of a document meet the lookup and each other without being moved one by one
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = docs.select(id_col, tokens).repartition(partitions, id_col)
    return retranslate(placed, F.broadcast(lookup), id_col, tokens)


def top_words(
    docs: DataFrame, group: str, n: int = 10, tokens: str = "tokens"
) -> DataFrame:
    """The ``n`` most frequent words of each group, ties by word."""
    counts = (
        docs.select(group, F.explode(to_explode(F.col(tokens))).alias("word"))
        .groupBy(group, "word")
        .agg(F.count("*").alias("n"))
    )
    return top_in_group(counts, group, "n", "word", n)


def top_in_group(df: DataFrame, group: str, weight: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows of largest ``weight`` per group, ranked from 1.

    The rank filter sits on the window, so Spark keeps at most ``n`` rows per
    group and partition before it shuffles.
    """
    order = Window.partitionBy(group).orderBy(F.desc(weight), F.col(tie))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
