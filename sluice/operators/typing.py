"""Column types found in text tables, and unions of tables that disagree on them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.cells import cell_number, empty_as_null, is_number, is_whole, null_markers

LONG, DOUBLE, STRING = "long", "double", "string"


def name_of(column: str) -> str:
    """A column name quoted for use in expressions."""
    return "`" + column.replace("`", "``") + "`"


def _prepared(df: DataFrame, column: str, blank: str, na_values: Iterable[str]):
    cell = null_markers(F.col(name_of(column)), na_values)
    return empty_as_null(cell) if blank == "null" else cell


def column_types(
    df: DataFrame,
    columns: list[str] | None = None,
    blank: str = "text",
    whole_numbers: bool = True,
    na_values: Iterable[str] = (),
) -> DataFrame:
    """One row per column: its type and the counts the type rests on.

    All columns are counted in one pass.  A column is numeric if every cell is a
    number; a blank cell is text unless ``blank="null"``, and a column without any
    cell is text.
    """
    if blank not in ("text", "null"):
        raise ValueError("blank must be 'text' or 'null'")
    columns = columns or df.columns
    counts = []
    for i, column in enumerate(columns):
        cell = _prepared(df, column, blank, na_values)
        counts += [
            F.count(cell).alias(f"cells_{i}"),
            F.count_if(is_number(cell)).alias(f"numbers_{i}"),
            F.count_if(is_whole(cell)).alias(f"wholes_{i}"),
        ]
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(column).alias("column"),
            F.col(f"cells_{i}").alias("n_cells"),
            F.col(f"numbers_{i}").alias("n_numbers"),
            F.col(f"wholes_{i}").alias("n_wholes"),
        )
        for i, column in enumerate(columns)
    ]
    some = F.col("n_cells") > 0
    whole = some & (F.col("n_wholes") == F.col("n_cells")) & F.lit(whole_numbers)
    number = some & (F.col("n_numbers") == F.col("n_cells"))
    kind = F.when(whole, LONG).when(number, DOUBLE).otherwise(STRING)
    return df.agg(*counts).select(F.inline(F.array(*entries))).withColumn("type", kind)


def typed(
    df: DataFrame,
    types: dict[str, str] | None = None,
    blank: str = "text",
    whole_numbers: bool = True,
    na_values: Iterable[str] = (),
) -> DataFrame:
    """The table with each text column cast to its type, found by ``column_types``."""
    if types is None:
        found = column_types(df, None, blank, whole_numbers, na_values)
        types = {row["column"]: row["type"] for row in found.collect()}
    cells = []
    for column in df.columns:
        cell = _prepared(df, column, blank, na_values)
        kind = types.get(column, STRING)
        if kind == LONG:
            cell = F.trim(cell).cast("long")
        elif kind == DOUBLE:
            cell = cell_number(cell)
        cells.append(cell.alias(column))
    return df.select(*cells)


def union_positions(tables: list[DataFrame]) -> DataFrame:
    """All rows of the tables, columns by position; every table must have as many."""
    widths = {len(t.columns) for t in tables}
    if len(widths) != 1:
        raise ValueError(f"tables differ in their number of columns: {sorted(widths)}")
    return reduce(DataFrame.union, tables)


def union_names(tables: list[DataFrame]) -> DataFrame:
    """All rows of the tables, columns by name; absent columns are null.

    Columns that differ in type are widened first: numbers to double, and anything
    with text to text, since the plain union would cast the text to a number.
    """
    kinds: dict[str, list[str]] = {}
    for t in tables:
        for column, kind in t.dtypes:
            kinds.setdefault(column, []).append(kind)
    wide = {column: _wider(found) for column, found in kinds.items()}
    aligned = [
        t.select(
            *[
                F.col(name_of(c)).cast(wide[c]).alias(c) if wide[c] else F.col(name_of(c))
                for c in t.columns
            ]
        )
        for t in tables
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def _wider(kinds: list[str]) -> str | None:
    whole = ("tinyint", "smallint", "int", "bigint")
    distinct = set(kinds)
    if len(distinct) == 1:
        return None
    if distinct <= set(whole):
        return max(distinct, key=whole.index)
    if distinct <= {*whole, "float", "double"}:
        return "double"
    return "string"
