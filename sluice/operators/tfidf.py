"""Term statistics and TF-IDF weights as long tables, and the same as MLlib vectors."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.bind import to_explode
from sluice.functions.text import counted, word_ngrams

# terms are counted by bucket before they are counted one by one
BUCKETS = 1 << 22
# a vocabulary of up to this many terms is sent to every task
BROADCAST_TERMS = 1_000_000
# words of the documents that a task holds to count their terms
WORDS_PER_TASK = 1 << 22
# the length of a document is told from those of one id in so many
MEASURED = 64


@dataclass(frozen=True)
class TfidfSettings:
    """Bounds are shares of the documents; the vocabulary keeps the commonest terms."""

    min_df: float = 0.001
    max_df: float = 0.7
    max_features: int = 200_000
    n_min: int = 1
    n_max: int = 3


def term_frequencies(
    docs: DataFrame,
    id_col: str = "doc_id",
    tokens: str = "tokens",
    n_min: int = 1,
    n_max: int = 3,
) -> DataFrame:
    """Occurrences of each term in each document: ``(id, term, tf)``.

    The token arrays of a document meet, not its terms, which are counted within its row.
    Arrays are held twice while they meet, so a task gets about ``WORDS_PER_TASK`` words at most.
    """
    placed = _placed(docs, id_col, tokens, _tasks_for(docs, id_col, tokens))
    whole = placed.groupBy(id_col).agg(F.collect_list(tokens).alias("_parts"))
    terms = F.flatten(F.transform("_parts", lambda part: word_ngrams(part, n_min, n_max)))
    return whole.select(id_col, F.inline(counted(terms)))


def _tasks_for(docs: DataFrame, id_col: str, tokens: str) -> int:
    """The tasks that all words of the documents need.

    All rows are counted; their mean length is that of a share of the ids, as making the words of
    all texts once more would take longer.  It says how rows are dealt out and nothing else.
    """
    measured = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(MEASURED)) == 0)
    mean = measured.agg(F.avg(F.size(tokens)).alias("words")).first()["words"] or 0.0
    return math.ceil(docs.count() * mean / WORDS_PER_TASK)


def _placed(docs: DataFrame, id_col: str, tokens: str, least: int = 1) -> DataFrame:
    """Token arrays by document, in ``least`` partitions or more.

    Terms weigh many times what their tokens do, so the session's own number of
    partitions is asked for and not left to be merged by size.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select(id_col, tokens).repartition(max(partitions, least), id_col)


def term_statistics(tf: DataFrame) -> DataFrame:
    """Documents with the term (``df``) and its occurrences in all (``cf``)."""
    return tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def frequent_statistics(grams: DataFrame, least: Column, id_col: str = "doc_id") -> DataFrame:
    """``term_statistics`` of the terms that ``least`` documents have, from a row ``(id, term)`` for each occurrence.

    Most terms are rare.  A term that enough documents have lies in a bucket of enough
    rows, so only the terms of such buckets are counted one by one.
    """
    bucket = F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int")
    sizes = grams.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    full = sizes.filter(F.col("_n") >= least).select("_bucket")
    held = grams.withColumn("_bucket", bucket).join(F.broadcast(full), "_bucket", "left_semi")
    tf = held.groupBy(id_col, "term").agg(F.count("*").alias("tf"))
    return term_statistics(tf).filter(F.col("df") >= least)


def row_count(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery."""
    return df.agg(F.count("*").alias("n")).scalar()


def tfidf_vocabulary(
    stats: DataFrame, docs: DataFrame, settings: TfidfSettings = TfidfSettings()
) -> DataFrame:
    """Terms within the document-share bounds, most frequent first up to the cap."""
    n = row_count(docs)
    return (
        stats.filter(
            (F.col("df") >= settings.min_df * n) & (F.col("df") <= settings.max_df * n)
        )
        .orderBy(F.desc("cf"), "term")
        .limit(settings.max_features)
    )


def gram_rows(
    docs: DataFrame, *keep: str, tokens: str = "tokens", n_min: int = 1, n_max: int = 3, min_length: int = 2
) -> DataFrame:
    """A row ``(keep, term)`` for each occurrence of the terms of ``word_ngrams``, in no order.

    Runs are joined where their first word stands, a row for each place, and never held as an array of a document.
    """
    long_words = F.filter(tokens, lambda word: F.length(word) >= min_length)
    if n_min == n_max == 1:
        return docs.select(*keep, F.explode(long_words).alias("term"))
    words = docs.select(*keep, long_words.alias("_words"))
    places = words.select("*", F.posexplode(to_explode(F.col("_words"))).alias("_at", "_w0"))
    later = [F.get("_words", F.col("_at") + n).alias(f"_w{n}") for n in range(1, n_max)]
    runs = places.select(*keep, "_w0", *later)
    # a run that goes past the last word is null
    blank = F.lit(" ")
    terms = [
        F.concat(*[part for n in range(size) for part in ([blank] if n else []) + [F.col(f"_w{n}")]])
        for size in range(n_min, n_max + 1)
    ]
    return runs.select(*keep, F.explode(F.array(*terms)).alias("term")).filter(F.col("term").isNotNull())


def _grams(placed: DataFrame, id_col: str, tokens: str, settings: TfidfSettings) -> DataFrame:
    return gram_rows(placed, id_col, tokens=tokens, n_min=settings.n_min, n_max=settings.n_max)


def vocabulary_of(
    docs: DataFrame,
    id_col: str = "doc_id",
    tokens: str = "tokens",
    settings: TfidfSettings = TfidfSettings(),
    placed: DataFrame | None = None,
) -> DataFrame:
    """The kept terms of the documents with their statistics; ``placed`` are the arrays by document, if there are."""
    if settings.n_max == 1:
        # single words are few enough to count them all
        stats = term_statistics(term_frequencies(docs, id_col, tokens, settings.n_min, settings.n_max))
    else:
        placed = _placed(docs, id_col, tokens) if placed is None else placed
        grams = _grams(placed, id_col, tokens, settings)
        stats = frequent_statistics(grams, settings.min_df * row_count(docs), id_col)
    return tfidf_vocabulary(stats, docs, settings)


def inverse_frequency(df: Column, n: Column) -> Column:
    return F.log((1 + n) / (1 + df)) + 1


def tfidf_weights(
    docs: DataFrame,
    id_col: str = "doc_id",
    tokens: str = "tokens",
    settings: TfidfSettings = TfidfSettings(),
    placed: bool = False,
) -> DataFrame:
    """L2-normalised TF-IDF weights ``(id, term, weight)`` of the kept vocabulary.

    The token arrays are placed by document once; the term counts and the norm of
    a document then need no shuffle of their own, as the vocabulary is broadcast.
    ``placed`` says that ``docs`` is partitioned by ``id_col`` already.
    """
    arrays = docs.select(id_col, tokens) if placed else _placed(docs, id_col, tokens)
    vocab = vocabulary_of(docs, id_col, tokens, settings, arrays)
    idf = vocab.select("term", inverse_frequency(F.col("df"), row_count(docs)).alias("idf"))
    if settings.max_features <= BROADCAST_TERMS:
        idf = F.broadcast(idf)
    # occurrences of other terms go before they are counted
    known = _grams(arrays, id_col, tokens, settings).join(idf, "term")
    raw = known.groupBy(id_col, "term").agg((F.count("*") * F.first("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", (F.col("w") / norm).alias("weight"))


def tfidf_vectorizer(
    docs: DataFrame,
    id_col: str = "doc_id",
    tokens: str = "tokens",
    settings: TfidfSettings = TfidfSettings(),
    output: str = "features",
) -> PipelineModel:
    """The same weights as a fitted chain of MLlib transformers over a ``terms`` array.

    Only the vocabulary, at most ``max_features`` rows, reaches the driver.
    """
    n = docs.count()
    kept = vocabulary_of(docs, id_col, tokens, settings).select("term", "df").collect()
    if not kept:
        raise ValueError("no term lies within the document-share bounds")
    idf = [math.log((1 + n) / (1 + row.df)) + 1 for row in kept]
    counts = CountVectorizerModel.from_vocabulary(
        [row.term for row in kept], inputCol="terms", outputCol="term_counts"
    )
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense(idf), inputCol="term_counts", outputCol="term_weights"
    )
    unit = Normalizer(p=2.0, inputCol="term_weights", outputCol=output)
    return PipelineModel([counts, scale, unit])


def tfidf_vectors(
    docs: DataFrame,
    id_col: str = "doc_id",
    tokens: str = "tokens",
    settings: TfidfSettings = TfidfSettings(),
    output: str = "features",
) -> DataFrame:
    """Add the unit-length TF-IDF vector of each document."""
    model = tfidf_vectorizer(docs, id_col, tokens, settings, output)
    terms = word_ngrams(F.col(tokens), settings.n_min, settings.n_max)
    return model.transform(docs.withColumn("terms", terms)).drop(
        "terms", "term_counts", "term_weights"
    )
