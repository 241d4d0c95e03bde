from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from sluice.functions.cells import cell_kind, cell_number
from sluice.operators import typing
from sluice.sources import workbook

NUMBERS = ["1", "1.5", " 1 ", ".5", "5.", "1e3", "nan", "inf", "-Infinity"]
TEXTS = ["1d", "1f", "1_000", "0x1F", "-", "", "abc"]


def test_cells_that_are_numbers(spark):
    rows = spark.createDataFrame([(c,) for c in NUMBERS + TEXTS], "c string")
    found = {r.c: r.n for r in rows.select("c", cell_number(F.col("c")).alias("n")).collect()}
    assert [c for c, n in found.items() if n is not None] == NUMBERS
    assert found["1e3"] == 1000 and found["-Infinity"] == -math.inf and math.isnan(found["nan"])


def test_cell_kinds(spark):
    rows = spark.createDataFrame([("1",), ("1.5",), ("x",), (None,), ("9" * 30,)], "c string")
    kinds = [r.k for r in rows.select(cell_kind(F.col("c")).alias("k")).collect()]
    assert kinds == ["long", "double", "string", None, "double"]
    assert rows.select(cell_kind(F.col("c"), False).alias("k")).first().k == "double"


def types_of(df, **options):
    return {r["column"]: r["type"] for r in typing.column_types(df, **options).collect()}


def test_a_blank_cell_makes_text_unless_told_otherwise(spark):
    rows = spark.createDataFrame([("1", "1.5"), ("", "2"), ("2", "NA")], "a string, b string")
    assert types_of(rows) == {"a": "string", "b": "string"}
    assert types_of(rows, blank="null", na_values=["NA"]) == {"a": "long", "b": "double"}
    cells = typing.typed(rows, blank="null", na_values=["NA"]).collect()
    assert [tuple(r) for r in cells] == [(1, 1.5), (None, 2.0), (2, None)]
    with pytest.raises(ValueError):
        typing.column_types(rows, blank="zero")


def test_no_rows_make_text(spark):
    assert types_of(spark.createDataFrame([], "a string, `b c` string")) == {
        "a": "string",
        "b c": "string",
    }


def tab(spark, *rows):
    return spark.createDataFrame(list(rows), "x string, y string, z string")


def test_workbook_drops_blank_rows_and_equal_headers(spark):
    header, blank = ("a", "b", "c"), ("", "", "")
    tabs = [
        tab(spark, header, ("1", "2", "3"), blank, header, ("", "", "4")),
        tab(spark, header, ("5", "6", "7"), header),
        tab(spark, ("a", "b", "other"), ("8", "9", "10")),
    ]
    rows = [tuple(r) for r in workbook.workbook_rows(tabs).collect()]
    assert rows == [
        (1, "1", "2", "3"), (1, "", "", "4"), (2, "5", "6", "7"),
        (3, "a", "b", "other"), (3, "8", "9", "10"),
    ]
    with pytest.raises(ValueError):
        workbook.workbook_rows([tabs[0], tabs[1].drop("z")], list(header))


def test_union_by_name_widens_types(spark):
    ints = spark.createDataFrame([(1,)], "id int")
    floats = spark.createDataFrame([(2.5, "x")], "id double, extra string")
    texts = spark.createDataFrame([("t",)], "id string")
    assert [tuple(r) for r in typing.union_names([ints, floats]).collect()] == [
        (1.0, None),
        (2.5, "x"),
    ]
    assert [r.id for r in typing.union_names([ints, texts]).collect()] == ["1", "t"]
    with pytest.raises(ValueError):
        typing.union_positions([ints, floats])


def test_rows_are_numbered_over_splits_and_files(spark, tmp_path):
    tab = tmp_path / "tab"
    tab.mkdir()
    first = [f"r{i},{i}" for i in range(200)]
    (tab / "a.csv").write_text("\n".join(["name,value", *first]) + "\n")
    (tab / "b.csv").write_text('"q,1",7\n,\nname,value\nlast,8\nshort\n')
    other = tmp_path / "other.csv"
    other.write_text("name,value\nx,1\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        found = [tuple(r) for r in workbook.workbook_from_files(spark, [str(tab), str(other)]).orderBy("tab_no", "row_no").collect()]
        assert spark.read.text(str(tab)).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(1, i + 2, f"r{i}", str(i)) for i in range(200)]
    want += [(1, 202, "q,1", "7"), (1, 205, "last", "8"), (1, 206, "short", ""), (2, 2, "x", "1")]
    assert found == want
