from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from sluice.functions.html import text_of
from sluice.functions.xml import node_lists
from sluice.sources import csv_folder, pages, payloads
from sluice.streaming import folder_ingest
from sluice.streaming.folder_ingest import ingest_new_files


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    return f"{folder}/*.csv"


def test_scan_by_pattern(spark, tmp_path):
    pattern = write(tmp_path, a="id,x\n1,1.5\n", b="id,x\n2,2\n")
    rows = csv_folder.read_csv_folder(spark, pattern, source_column="file").collect()
    assert sorted(tuple(r) for r in rows) == [(1, 1.5, "a.csv"), (2, 2.0, "b.csv")]


def test_concat_of_files_that_differ(spark, tmp_path):
    pattern = write(
        tmp_path, ints="id,v\n1,1\n2,\n", text="id,v\nx,2.5\n", extra="more,id\n7,NA\n"
    )
    df = csv_folder.concat_csv_folder(spark, pattern, na_values=["NA"])
    assert dict(df.dtypes) == {"id": "string", "v": "double", "more": "bigint"}
    rows = {(r.id, r.v, r.more) for r in df.collect()}
    assert rows == {("1", 1.0, None), ("2", None, None), ("x", 2.5, None), (None, None, 7)}


def test_headerless_rows_with_crlf(spark, tmp_path):
    pattern = write(tmp_path, p='1,"a,b"\r\n2,c\r\n')
    rows = csv_folder.read_headerless_csv(spark, pattern, ["key", "kind"]).collect()
    assert [tuple(r) for r in rows] == [("1", "a,b"), ("2", "c")]


def test_export_is_gzip_with_header(spark, tmp_path):
    path = csv_folder.export_csv(spark.range(3).coalesce(1), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*.csv.gz")
    assert gzip.decompress(file.read_bytes()).decode().split() == ["id", "0", "1", "2"]
    assert path == str(tmp_path / "out")


def test_convert_keeps_one_folder_per_input(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / f"{name}.json").write_text('{"a": 1}\n')
    out = csv_folder.convert_folder(spark, f"{tmp_path}/*.json", str(tmp_path / "out"), "json")
    found = spark.read.option("header", True).csv(out)
    assert {r.source_file for r in found.collect()} == {"one.json", "two.json"}


def test_stream_takes_each_file_once(spark, tmp_path):
    inbox, out, state = (tmp_path / n for n in ("inbox", "out", "state"))
    inbox.mkdir()

    def run():
        ingest_new_files(spark, str(inbox), "id int", str(out), str(state)).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(str(out)).collect())

    write(inbox, a="id\n1\n")
    assert run() == [1]
    write(inbox, b="id\n2\n")
    assert run() == [1, 2]
    assert (inbox / "a.csv").exists()
    with pytest.raises(ValueError):
        ingest_new_files(spark, str(inbox), "id int", str(out), str(state), "archive")


XML = [
    (1, "<a><b>1</b><b>2</b><t>x</t></a>"),
    (2, "<a><b>1</a>"),
    (3, None),
    (4, "<a><b>1</b><t>x</t><t>y</t></a>"),
    (5, "<a></a>"),
]


@pytest.fixture
def xml(spark):
    return spark.createDataFrame(XML, "id int, payload string")


def test_malformed_xml_gives_nulls_and_not_an_error(xml):
    nodes = xml.select("id", payloads.node_texts(F.col("payload"), "/a/b").alias("n")).collect()
    assert {r.id: r.n for r in nodes} == {1: ["1", "2"], 2: None, 3: None, 4: ["1"], 5: []}


def arrays(xml):
    texts = {"v": "/a/b", "t": "/a/t"}
    return xml.select(
        "id", *[payloads.node_texts(F.col("payload"), p).alias(n) for n, p in texts.items()]
    )


def test_zip_has_the_length_of_the_values(xml):
    rows = [tuple(r) for r in payloads.zipped_nodes(arrays(xml), "v", "t", ["id"]).collect()]
    assert rows == [(1, 0, "1", "x", "x!"), (1, 1, "2", None, None), (4, 0, "1", "x", "x!")]


def test_failed_inputs_become_filler_rows(xml):
    rows = payloads.rows_with_failures(arrays(xml), "v", "t", ["id"]).collect()
    assert [(r.id, r.pos, r.value, r.error) for r in rows] == [
        (1, 0, "1", False), (1, 1, "2", False), (2, None, None, True), (3, None, None, True),
        (4, 0, "1", False),
    ]


def test_json_that_cannot_be_read(spark):
    rows = spark.createDataFrame([('{"k": 1}',), ("{bad",), (None,)], "p string")
    parsed = payloads.with_json(rows, "p", "k int").select("record.k", "ok").collect()
    assert [tuple(r) for r in parsed] == [(1, True), (None, False), (None, False)]


PAGE = (
    "<html><!-- <b>no</b> --><script>var x = '</p><i>no</i>';</script>"
    '<div class="box ad" id=d1 id="d2">one &amp; two</div><p><b>bold<br/>'
    "<a href='/x?a=1&amp;b=2' title=\"a > b\" disabled>link</a><p class='ad'>&lt;last"
)


def test_page_elements(spark):
    page = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    elements = pages.page_elements(page)
    rows = {r.pos: (r.tag, r.attrs, r.text) for r in elements.collect()}
    assert [rows[i][0] for i in sorted(rows)] == ["html", "div", "p", "b", "br", "a", "p"]
    assert rows[1] == ("div", {"class": "box ad", "id": "d2"}, "one & two")
    assert rows[5][1] == {"href": "/x?a=1&b=2", "title": "a > b", "disabled": ""}
    assert rows[6][2] == "<last"
    first = pages.first_elements(elements, css_class="ad").collect()
    assert [tuple(r) for r in first] == [(1, 1, "one & two")]
    assert pages.select_elements(elements, tag="p", css_class="ad").count() == 1
    assert pages.select_elements(elements, attribute="id", value="d2").count() == 1
    values = pages.attribute_values(elements, "title", attribute="href")
    assert [r.value for r in values.collect()] == ["a > b"]
    assert page.select(text_of(F.col("html")).alias("t")).first().t == "one & two bold link <last"


def test_node_texts_have_an_entry_for_each_node(spark):
    rows = [(1, "<a><b>1</b><b/><b>3</b></a>"), (2, "<a><b>x<c>y</c>z&amp;</b></a>"), (3, "<a></b>")]
    df = spark.createDataFrame(rows, "id int, payload string")
    got = {r.id: r.n for r in df.select("id", payloads.node_texts(F.col("payload"), "/a/b").alias("n")).collect()}
    assert got == {1: ["1", "", "3"], 2: ["xyz&"], 3: None}


PAYLOADS = [
    "<r><v>1</v><v>x<w a='1>2'>y</w>q</v><v/><t>a&lt;b&gt;c</t><v> sp </v></r>",
    "<r><v><![CDATA[a<b>c & d]]></v><!-- <v>no</v> --><v>p<!-- c -->q<![CDATA[<i>]]></v></r>",
    "<r><v>1</r>", None, "", "x", "<r><s><v>deep</v></s></r>", "<r/>", "<q><v>1</v></q>", "<r></r>", "<r><v>a</v></r><r/>",
    "<?xml version='1.0'?><!-- c --><r><v at='3&amp;'>7</v><v><w>only</w></v><v>\n two\n <w>k</w></v></r>\n",
    "<r><v>&#233;&#x1F600;&amp;lt;&amp;#65;</v><v>&quot;&apos;</v></r>", "<r><v>a & b</v></r>", "<r><v>&nosuch;</v></r>",
    "<r><v>a</v><t>&bad</t></r>", "<r><n>text</n><n><v>1</v><v>2</v></n><n/><n><v/></n><v>z</v></r>", "<r><v>\ue000lt;</v></r>",
    "<r><v><![CDATA[open</v></r>", "<r><v><![CDATA[]]></v><v>é漢</v></r>",
]


def test_native_nodes_equal_the_parser(spark):
    df = spark.createDataFrame(list(enumerate(PAYLOADS)), "id int, payload string")
    paths = {"v": "/r/v", "t": "/r/t", "deep": "/r/n/v"}
    found = df.select("id", node_lists(F.col("payload"), paths).alias("n")).select("id", "n.*").collect()
    for row in found:
        for name, path in paths.items():
            want = None if PAYLOADS[row.id] is None else payloads.inner_texts(PAYLOADS[row.id], path[1:], False)
            assert row[name] == want, (PAYLOADS[row.id], path)
    plan = df.select(node_lists(F.col("payload"), paths))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    for bad in ({"a": "/r/v", "b": "/q/v"}, {"a": "/r/v", "b": "/r/v/w"}, {"a": "/r"}):
        with pytest.raises(ValueError):
            node_lists(F.col("payload"), bad)


def test_replayed_batches_load_once(spark, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    inbox.mkdir()
    for n in range(3):
        write(inbox, **{f"f{n}": f"id,x\n{n},1\n{n + 10},2\n"})
        folder_ingest.load_new_files(spark, str(inbox), "id int, x int", out, str(state), "s", 1).awaitTermination()
        for file in (state / "commits").glob(f"*{n}*"):
            file.unlink()
    folder_ingest.load_new_files(spark, str(inbox), "id int, x int", out, str(state), "s", 1).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 10, 11, 12]
    assert sorted(tuple(r) for r in folder_ingest.loaded_batches(spark, out).collect()) == [(f"s_{n:012d}", 2) for n in range(3)]
    with pytest.raises(ValueError):
        folder_ingest.load_new_files(spark, str(inbox), "id int", out, str(state), "a b")
