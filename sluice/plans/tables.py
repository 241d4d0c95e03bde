"""Readers of the parquet tables the registered queries run on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import text_words

# Domain words without meaning of their own, deleted wherever they occur.
DOMAIN_WORDS = ("worthless", "keit")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread the rows of a table that has fewer files than there are cores.

    A file of one row group is read by one task, which then does all the work on
    its texts.  Tables of many files keep the partitions of their scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if len(df.inputFiles()) < cores else df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents that have a text, with the columns given."""
    docs = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull())
    return spread(docs.select("doc_id", *columns), "doc_id")


def score() -> Column:
    """Characters per blank-separated word, rounded down: the score column ``ltr``."""
    return F.floor(F.col("n_chars") / F.size(F.split("text", r"\s+")))


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a score: the input of the topic job, pruned to three columns."""
    docs = documents(spark, sf_dir, "text", "n_chars")
    return docs.select("doc_id", "text", score().alias("ltr"))


def tokenised(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """All documents as word arrays, with the columns of ``keep``."""
    docs = documents(spark, sf_dir, *keep, "text")
    return docs.select("doc_id", *keep, text_words(F.col("text"), DOMAIN_WORDS).alias("tokens"))
