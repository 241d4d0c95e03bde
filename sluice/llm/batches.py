"""Helpers shared by the operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sluice.session import scratch_path

# ASCII blanks: the bytes that bytes.split() takes as separators.
BLANKS = " \t\n\v\f\r"


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut batches, so that what is derived from one of them stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch, a null as an empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def words_of(text: str, lower: bool = False) -> list[bytes]:
    """Runs of anything but ASCII blanks, as UTF-8, with A-Z lowered if asked."""
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def table_at(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table of the data folder."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: lost executors cost nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_partitions(df: DataFrame) -> int:
    """Partitions in which Spark reads ``df``: a measure of its size."""
    return max(1, df.rdd.getNumPartitions())
