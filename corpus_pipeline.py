"""The corpus pipeline: quality rules, toxicity, near duplicates, personal data, packing.

All stages take null ids, null, empty and very long texts, repeated rows, an empty table and columns of any other name: texts
without words are too short for the first stage, whatever comes after it keeps all columns, and packing gives the
columns of its own.  What each does with such rows is said where it is defined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.batches import stored, table_at
from sluice.llm.best_fit import pack_documents
from sluice.llm.parity_join import keep_one_of_each
from sluice.llm.pii_anchors import mask_documents
from sluice.llm.repetition import keep_unrepeated
from sluice.llm.toxicity import fit, keep_civil

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are short, null ones among them, or repeat themselves; rows of the same text share their fate."""
    return keep_unrepeated(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops toxic texts, by a model fitted on the labelled ones among ``docs``; without such rows all stay."""
    return keep_civil(docs, fit(docs, table_at(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each group of near copies; rows with a null id or without words all stay."""
    return keep_one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data and secrets; null texts stay null."""
    return mask_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the texts' tokens in sequences; null and empty texts are an end token each."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("packing", packing),
]

# Suffix arrays, a fitted model and tokens of a vocabulary are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each to what the one before it has written; an empty table gives no rows."""
    docs = table_at(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
