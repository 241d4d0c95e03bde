"""CSV folders: scans by name pattern, exports and folder conversion."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.typing import typed


def read_csv_folder(
    spark: SparkSession,
    pattern: str,
    schema: T.StructType | str | None = None,
    source_column: str | None = None,
) -> DataFrame:
    """All files that match the pattern, with equal header rows, as one table.

    Give ``schema`` for large folders: without it Spark reads the files once more
    to find the types.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    df = reader.csv(pattern)
    if source_column:
        df = df.select("*", F.col("_metadata.file_name").alias(source_column))
    return df


def read_headerless_csv(
    spark: SparkSession, path: str, columns: Iterable[str], line_end: str = "\r\n"
) -> DataFrame:
    """Rows without a header, all text, with the given column names."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("lineSep", line_end).csv(path)


def header_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """The first line of each file: ``(path, header)``; only the first split is looked at."""
    lines = spark.read.text(pattern).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    return (
        lines.filter(F.col("start") == 0)
        .groupBy("path")
        .agg(F.min_by("value", "line").alias("header"))
    )


def concat_csv_folder(
    spark: SparkSession,
    pattern: str,
    na_values: Iterable[str] = (),
    source_column: str | None = None,
) -> DataFrame:
    """Files whose columns may differ, joined by column name with one type per column.

    Files with the same header are read together.  All cells stay text until the
    union is made, then one pass finds the type of each column: numbers where
    every file has numbers, text where any has text.
    """
    groups = (
        header_lines(spark, pattern)
        .groupBy("header")
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .orderBy(F.col("paths")[0])
        .collect()
    )
    tables = [spark.read.option("header", True).csv(list(g.paths)) for g in groups]
    if source_column:
        tables = [
            t.select("*", F.col("_metadata.file_name").alias(source_column)) for t in tables
        ]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return typed(whole, blank="null", na_values=na_values)


def export_csv(df: DataFrame, path: str, compress: bool = True, header: bool = True) -> str:
    """Write CSV, by default with a header and gzip, one file per partition; return the path."""
    codec = "gzip" if compress else "none"
    df.write.option("header", header).option("compression", codec).csv(path)
    return path


def convert_folder(
    spark: SparkSession, pattern: str, out: str, from_format: str = "parquet"
) -> str:
    """Every input file as CSV in a folder of its own, named by the input file."""
    rows = spark.read.format(from_format).load(pattern)
    named = rows.select("*", F.col("_metadata.file_name").alias("source_file"))
    named.write.option("header", True).partitionBy("source_file").csv(out)
    return out
