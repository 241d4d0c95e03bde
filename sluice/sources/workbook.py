"""Workbooks: tabs of text cells that share one header."""

from __future__ import annotations

import csv
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.operators.typing import name_of, union_positions


def read_tabs(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """One all-text table per tab, each tab being a CSV file without a header row."""
    return [spark.read.option("header", False).csv(path).na.fill("") for path in paths]


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(row_no, value)``: the lines of a file, or of the files of a folder in the order of their names, from 1 on.

    Each split of a file numbers its own lines and starts where the splits before it end, so that no task
    reads more than its split.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    sizes = lines.groupBy(F.col("file").alias("of_file"), F.col("block").alias("of_block")).agg(F.count("*").alias("n"))
    # One row for each split of the files: few, whatever the number of lines.
    before = Window.partitionBy(F.lit(0)).orderBy("of_file", "of_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("of_file", "of_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    local = F.row_number().over(Window.partitionBy("file", "block").orderBy("place"))
    placed = lines.withColumn("local", local)
    same = (placed["file"] == starts["of_file"]) & (placed["block"] == starts["of_block"])
    return placed.join(starts, same).select((F.col("start") + F.col("local")).alias("row_no"), "value")


def workbook_from_files(spark: SparkSession, paths: list[str], header: list[str] | None = None) -> DataFrame:
    """All data rows of all tabs, each a CSV file or folder, as ``(tab_no, row_no, cells…)``.

    ``row_no`` is the row's number on its tab, header and blank rows counted.  Columns are named by the first row of the first
    tab.  Lacking cells are empty; a cell holds no line break, as rows are lines.
    """
    tabs = [numbered_lines(spark, path) for path in paths]
    if header is None:
        first = tabs[0].filter("row_no = 1").first()
        if first is None:
            raise ValueError("the first tab is empty")
        header = next(csv.reader([first["value"]]))
    fields = ", ".join(f"_c{i} string" for i in range(len(header)))
    read = F.from_csv("value", fields, {"mode": "PERMISSIVE"})
    cells = [F.coalesce(F.col("cells")[f"_c{i}"], F.lit("")).alias(name) for i, name in enumerate(header)]
    rows = [
        tab.select(F.lit(i).alias("tab_no"), "row_no", read.alias("cells")).select("tab_no", "row_no", *cells)
        for i, tab in enumerate(tabs, 1)
    ]
    return without_header_rows(without_blank_rows(reduce(DataFrame.unionAll, rows), header), header)


def header_of(tab: DataFrame) -> list[str]:
    """The first row of the first tab."""
    first = tab.first()
    if first is None:
        raise ValueError("the first tab is empty")
    return list(first)


def workbook_rows(tabs: list[DataFrame], header: list[str] | None = None) -> DataFrame:
    """All data rows of all tabs, named by the first tab's header, with ``tab_no``.

    Rows go together by position.  Rows with nothing but empty cells are dropped,
    and so is every row equal to the header, wherever it stands.
    """
    header = header or header_of(tabs[0])
    numbered = [tab.select(F.lit(i).alias("tab_no"), "*") for i, tab in enumerate(tabs, 1)]
    rows = union_positions(numbered).toDF("tab_no", *header)
    return without_header_rows(without_blank_rows(rows, header), header)


def without_blank_rows(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop the rows in which every cell is the empty string."""
    cells = [_cell(c) for c in columns or rows.columns]
    return rows.filter(reduce(or_, [~cell.eqNullSafe("") for cell in cells]))


def without_header_rows(rows: DataFrame, header: list[str]) -> DataFrame:
    """Drop the rows that repeat the header."""
    return rows.filter(~reduce(and_, [_cell(c).eqNullSafe(c) for c in header]))


def _cell(column: str) -> Column:
    return F.col(name_of(column))
