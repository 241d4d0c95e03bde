"""Registered queries on CSV folders, workbooks, payloads and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.cells import cell_kind, cell_number
from sluice.functions.html import text_of
from sluice.functions.text import iso_to_timestamp
from sluice.functions.xml import node_lists
from sluice.operators import load, typing
from sluice.plans.registry import query
from sluice.plans.tables import table
from sluice.session import scratch_path
from sluice.sources import csv_folder, pages, payloads, workbook
from sluice.streaming.folder_ingest import load_new_files

PART_TYPES = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size bigint, p_retailprice double"

# --- CSV folders ---------------------------------------------------------------


@query(
    "select p_partkey, p_name, p_brand, p_type, p_size::bigint as p_size, p_retailprice from part"
)
def csv_folder_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = csv_folder.export_csv(table(spark, sf, "part"), scratch_path(spark, "csv"), False)
    return csv_folder.read_csv_folder(spark, f"{path}/*.csv", PART_TYPES)


@query(
    """select p_partkey as key, p_name as name, p_retailprice as amount, p_brand as brand,
      null::bigint as nation from part
    union all by name
    select s_suppkey as key, s_name as name, s_acctbal as amount, s_nationkey::bigint as nation
      from supplier
    union all by name
    select c_custkey as key, c_name as name, c_acctbal as amount, c_nationkey::bigint as nation
      from customer"""
)
def csv_folder_concat(spark: SparkSession, sf: str) -> DataFrame:
    """Three kinds of files in one folder, with columns that differ."""
    root = scratch_path(spark, "mixed")
    for name, columns in {
        "part": "p_partkey key, p_name name, p_retailprice amount, p_brand brand",
        "supplier": "s_suppkey key, s_name name, s_acctbal amount, s_nationkey nation",
        "customer": "c_nationkey nation, c_custkey key, c_name name, c_acctbal amount",
    }.items():
        rows = table(spark, sf, name).selectExpr(*columns.split(", "))
        csv_folder.export_csv(rows, f"{root}/{name}", False)
    return csv_folder.concat_csv_folder(spark, f"{root}/*/*.csv")


@query("select c_custkey::varchar as param, c_mktsegment as kind from customer")
def headerless_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "headerless")
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    rows.write.option("lineSep", "\r\n").csv(path)
    return csv_folder.read_headerless_csv(spark, path, ["param", "kind"])


@query(
    """select c_custkey::varchar as param, c_mktsegment as kind from customer
    where c_mktsegment in ('BUILDING', 'MACHINERY')"""
)
def param_filter(spark: SparkSession, sf: str) -> DataFrame:
    params = headerless_csv_scan(spark, sf)
    return params.filter(F.col("kind").isin("BUILDING", "MACHINERY"))


@query(
    """select 'part.parquet' as source_file, p_partkey as key, p_name as name from part
    union all select 'supplier.parquet', s_suppkey, s_name from supplier"""
)
def convert_folder(spark: SparkSession, sf: str) -> DataFrame:
    """Two parquet inputs converted to one CSV folder each, read back with the folders' names."""
    found = []
    for name, key, label in (("part", "p_partkey", "p_name"), ("supplier", "s_suppkey", "s_name")):
        out = scratch_path(spark, "converted")
        csv_folder.convert_folder(spark, f"{sf}/{name}.parquet", out)
        read = spark.read.option("header", True).csv(out)
        found.append(read.select("source_file", F.col(key).cast("long").alias("key"), F.col(label).alias("name")))
    return found[0].union(found[1])


@query(
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from orders"""
)
def export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    path = csv_folder.export_csv(orders, scratch_path(spark, "export"))
    return spark.read.option("header", True).schema(orders.schema).csv(path)


# --- workbooks and cells ---------------------------------------------------------

HEADER = ["key", "name", "nation", "balance", "segment"]
TEXT_CUSTOMER = (
    "select c_custkey::varchar as key, c_name as name, c_nationkey::varchar as nation, "
    "c_acctbal::varchar as balance, c_mktsegment as segment from customer"
)


def _customer_text(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    cells = [F.col(c).cast("string").alias(h) for c, h in zip(columns, HEADER, strict=True)]
    return table(spark, sf, "customer").select(*cells)


def _sheet(rows: DataFrame) -> DataFrame:
    """The rows as a sheet: a header row before each, and a blank row where it is in debt."""
    header = F.array(*[F.lit(h) for h in HEADER])
    blank = F.array(*[F.lit("") for _ in HEADER])
    debt = F.col("balance").startswith("-")
    cells = F.array(header, F.array(*HEADER), F.when(debt, blank).otherwise(header))
    row = rows.select(F.explode(cells).alias("c"))
    return row.select(*[F.col("c")[i].alias(f"_c{i}") for i in range(len(HEADER))])


def _tabs(spark: SparkSession, sf: str) -> list[DataFrame]:
    rows = _customer_text(spark, sf)
    debt = F.col("balance").startswith("-")
    return [_sheet(rows.filter(~debt)), _sheet(rows.filter(debt))]


@query(
    f"""select case when balance like '-%' then 2 else 1 end as tab_no, key, name, nation,
    balance, segment from ({TEXT_CUSTOMER})"""
)
def workbook_rows(spark: SparkSession, sf: str) -> DataFrame:
    return workbook.workbook_rows(_tabs(spark, sf))


@query(
    f"""select tab_no, 3 * row_number() over (partition by tab_no order by key::bigint) - 1 as row_no,
    key, name, nation, balance, segment
    from (select *, case when balance like '-%' then 2 else 1 end as tab_no from ({TEXT_CUSTOMER}))"""
)
def workbook_row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Tabs read from files, with the number of each row on its tab; a header stands before each row."""
    rows = _customer_text(spark, sf).orderBy(F.col("key").cast("long"))
    debt = F.col("balance").startswith("-")
    paths = [
        csv_folder.export_csv(_sheet(rows.filter(own)), scratch_path(spark, "tab"), False, header=False) for own in (~debt, debt)
    ]
    return workbook.workbook_from_files(spark, paths)


@query(
    f"""select key, name, nation, balance, segment from ({TEXT_CUSTOMER})
    union all select 'key', 'name', 'nation', 'balance', 'segment' from customer
    union all select 'key', 'name', 'nation', 'balance', 'segment' from ({TEXT_CUSTOMER})
      where balance not like '-%'"""
)
def workbook_drop_blank(spark: SparkSession, sf: str) -> DataFrame:
    sheets = typing.union_positions(_tabs(spark, sf)).toDF(*HEADER)
    return workbook.without_blank_rows(sheets)


@query(
    f"""select key::bigint as key, name, nation::bigint as nation, balance::double as balance,
    segment, case when balance like '-%' then 2 else 1 end::bigint as tab_no
    from ({TEXT_CUSTOMER})"""
)
def typed_workbook(spark: SparkSession, sf: str) -> DataFrame:
    """A workbook with its columns typed by one pass over all cells."""
    rows = workbook.workbook_rows(_tabs(spark, sf), HEADER)
    return typing.typed(rows.withColumn("tab_no", F.col("tab_no").cast("string")))


@query(
    f"""select u.key, u.col as "column", case
      when regexp_matches(cell, '^\\s*[+-]?\\d+\\s*$') then 'long'
      when regexp_matches(cell, '^\\s*[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
      then 'double' else 'string' end as kind, try_cast(cell as double) as number
    from (select key, unnest(['name', 'nation', 'balance', 'segment']) as col,
      unnest([name, nation, balance, segment]) as cell from ({TEXT_CUSTOMER})) u"""
)
def cell_typing(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customer_text(spark, sf)
    cells = rows.unpivot("key", HEADER[1:], "column", "cell")
    cell = F.col("cell")
    return cells.select("key", "column", cell_kind(cell).alias("kind"), cell_number(cell).alias("number"))


@query(
    f"""with t as ({TEXT_CUSTOMER})
    select 0 as position, 'key' as "column", count(*) as n_cells, count(*) as n_numbers,
      count(*) as n_wholes, 'long' as type from t
    union all select 1, 'name', count(*), 0, 0, 'string' from t
    union all select 2, 'nation', count(*), count(*), count(*), 'long' from t
    union all select 3, 'balance', count(*), count(*),
      count_if(regexp_matches(balance, '^-?\\d+$')), 'double' from t
    union all select 4, 'segment', count(*), 0, 0, 'string' from t"""
)
def column_typing(spark: SparkSession, sf: str) -> DataFrame:
    return typing.column_types(_customer_text(spark, sf))


# --- JSON and XML payloads -------------------------------------------------------


@query(
    """select event_id, user_id, case when event_id % 7 <> 0 then (props->>'k')::int end as k,
    event_id % 7 <> 0 as ok from events"""
)
def json_payload_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Saved JSON responses, each seventh of them cut off."""
    cut = F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    events = payloads.with_json(table(spark, sf, "events").withColumn("props", cut), "props", "k int")
    return events.select("event_id", "user_id", F.col("record.k").alias("k"), "ok")


XML_SCHEMA = "n array<struct<v: string>>, t array<string>"


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    """One saved XML response per order; those of urgent orders are cut off.

    The third value holds a node inside, the fourth is empty.
    """
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    orders = table(spark, sf, "orders")
    body = F.concat(
        F.lit("<order><n><v>"), F.col("o_custkey"), F.lit("</v></n><n><v>"), F.col("o_orderstatus"),
        F.lit("</v></n><n><v>"), F.substring("o_orderpriority", 1, 2), F.lit("<w>"),
        F.substring("o_orderpriority", 3, 99), F.lit("</w></v></n><n><v/></n><t>"), stamp,
        F.lit("</t><t>"), stamp, F.lit("</t>"),
    )
    end = F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise("</order>")
    return orders.select("o_orderkey", "o_custkey", F.concat(body, end).alias("payload"))


XML_NODES = """nodes as (select o_orderkey, o_custkey, o_orderpriority = '1-URGENT' as bad,
  [o_custkey::varchar, o_orderstatus, o_orderpriority, ''] as v,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as t from orders)"""
XML_ROWS = """rows as (select o_orderkey, o_custkey, unnest([0, 1, 2, 3]) as pos, unnest(v) as value,
  unnest([t, t, null, null]) as time, unnest([t || '!', t || '!', null, null]) as marked
  from nodes where not bad)"""


@query(
    f"""with {XML_NODES} select o_orderkey, not bad as ok,
    case when bad then null else v[2] end as status, case when bad then null else t end as time
    from nodes"""
)
def xml_payload_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = payloads.with_xml(_responses(spark, sf), "payload", XML_SCHEMA)
    status = F.when(F.col("ok"), F.col("record.n")[1]["v"])
    time = F.when(F.col("ok"), F.col("record.t")[0])
    return parsed.select("o_orderkey", "ok", status.alias("status"), time.alias("time"))


@query(f"with {XML_NODES}, {XML_ROWS} select o_orderkey, pos, value from rows")
def xml_nodes_explode(spark: SparkSession, sf: str) -> DataFrame:
    nodes = payloads.node_texts(F.col("payload"), "/order/n/v")
    return _responses(spark, sf).select("o_orderkey", F.posexplode(nodes).alias("pos", "value"))


def _node_arrays(responses: DataFrame) -> DataFrame:
    """Values and times of each response; null where it cannot be read."""
    paths = {"values": "/order/n/v", "times": "/order/t"}
    return responses.withColumn("nodes", node_lists(F.col("payload"), paths)).select("*", "nodes.*").drop("nodes")


@query(f"with {XML_NODES}, {XML_ROWS} select o_orderkey, pos, value, time, marked from rows")
def xml_nodes_zip(spark: SparkSession, sf: str) -> DataFrame:
    arrays = _node_arrays(_responses(spark, sf))
    return payloads.zipped_nodes(arrays, "values", "times", ["o_orderkey"])


@query(
    f"""with {XML_NODES}, {XML_ROWS}
    select o_orderkey, pos, value, time, marked, false as error from rows
    union all select o_orderkey, null, null, null, null, true from nodes where bad"""
)
def dead_letter_rows(spark: SparkSession, sf: str) -> DataFrame:
    arrays = _node_arrays(_responses(spark, sf))
    return payloads.rows_with_failures(arrays, "values", "times", ["o_orderkey"])


@query(
    f"""with {XML_NODES}, {XML_ROWS},
    params as (select c_custkey as o_custkey from customer
      where c_mktsegment in ('BUILDING', 'MACHINERY')),
    failed as (select p.o_custkey, n.o_orderkey from params p
      left join nodes n using (o_custkey) where n.o_orderkey is null or n.bad)
    select o_custkey, o_orderkey, pos, value, time, marked, false as error
    from params join rows using (o_custkey)
    union all select o_custkey, o_orderkey, null, null, null, null, true from failed"""
)
def enrich_from_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen parameters with the rows of their saved responses, or a row of nulls."""
    params = table(spark, sf, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    params = params.select(F.col("c_custkey").alias("o_custkey"))
    joined = payloads.enriched(params, _responses(spark, sf), "o_custkey")
    return payloads.rows_with_failures(
        _node_arrays(joined), "values", "times", ["o_custkey", "o_orderkey"]
    )


@query("select event_id, date_trunc('second', ts)::timestamp as ts from events")
def iso_timestamp_clean(spark: SparkSession, sf: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    events = table(spark, sf, "events").select("event_id", text.alias("text"))
    return events.select("event_id", iso_to_timestamp(F.col("text")).alias("ts"))


# --- pages -----------------------------------------------------------------------

CONTENT = (
    "regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g')"
)
SQL_TAG = (
    """'<([a-zA-Z][a-zA-Z0-9]*)([^>"'']*(?:"[^"]*"[^>"'']*|''[^'']*''[^>"'']*)*)>([^<]*)'"""
)


def _decoded(sql: str) -> str:
    for entity, char in (
        ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"),
        ("&nbsp;", "chr(160)"), ("&amp;", "'&'"),
    ):
        sql = f"replace({sql}, '{entity}', {char})"
    return sql


ELEMENTS = f"""content as (select page_id, {CONTENT} as c from pages),
found as (select page_id, lower(unnest(regexp_extract_all(c, {SQL_TAG}, 1))) as tag,
  unnest(regexp_extract_all(c, {SQL_TAG}, 2)) as a,
  {_decoded(f"unnest(regexp_extract_all(c, {SQL_TAG}, 3))")} as text,
  unnest(range(len(regexp_extract_all(c, {SQL_TAG}, 1))))::int as pos from content),
elements as (select page_id, pos, tag, text,
  case when regexp_matches(a, '\\bhref="') then
    {_decoded("regexp_extract(a, chr(92) || 'bhref=\"([^\"]*)\"', 1)")} end as href,
  case when regexp_matches(a, '\\bclass="') then
    {_decoded("regexp_extract(a, chr(92) || 'bclass=\"([^\"]*)\"', 1)")} end as class from found)"""


def _elements(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_elements(table(spark, sf, "pages"))


@query(f"with {ELEMENTS} select page_id, pos, tag, href, class, text from elements")
def page_elements(spark: SparkSession, sf: str) -> DataFrame:
    attrs = F.col("attrs")
    return _elements(spark, sf).select(
        "page_id", "pos", "tag", attrs["href"].alias("href"), attrs["class"].alias("class"), "text"
    )


@query(
    f"""with {ELEMENTS} select page_id, pos, text from elements where class = 'ad'
    qualify row_number() over (partition by page_id order by pos) = 1"""
)
def page_first_by_class(spark: SparkSession, sf: str) -> DataFrame:
    return pages.first_elements(_elements(spark, sf), css_class="ad")


@query(f"with {ELEMENTS} select page_id, pos, href as value from elements where href is not null")
def page_attr_values(spark: SparkSession, sf: str) -> DataFrame:
    return pages.attribute_values(_elements(spark, sf), "href", attribute="href")


@query(f"with {ELEMENTS} select page_id, pos, tag, text from elements where tag = 'p'")
def page_select_all(spark: SparkSession, sf: str) -> DataFrame:
    return pages.select_elements(_elements(spark, sf), tag="p").select(
        "page_id", "pos", "tag", "text"
    )


@query(
    f"""select page_id, trim(regexp_replace({_decoded(f'''regexp_replace({CONTENT},
    '</?[a-zA-Z!](?:[^>"'']*(?:"[^"]*"[^>"'']*|''[^'']*''[^>"'']*)*)>', ' ', 'g')''')},
    '\\s+', ' ', 'g')) as text from pages"""
)
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", text_of(F.col("html")).alias("text"))


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def ingest_with_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Files that come in two runs, the first of which is replayed as if it had failed before its commit."""
    inbox, out, state = (scratch_path(spark, n) for n in ("inbox", "ingested", "ingest-state"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    for half in (0, 1):
        suppliers.filter(F.col("s_suppkey") % 2 == half).write.mode("append").option("header", True).csv(inbox)
        load_new_files(spark, inbox, suppliers.schema, out, state, "suppliers").awaitTermination()
        if half == 0:
            load.remove(spark, f"{state}/commits/0")
    return spark.read.schema(suppliers.schema).parquet(out).select(suppliers.columns)
