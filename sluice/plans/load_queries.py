"""Registered queries on what a table holds after a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import load
from sluice.plans.registry import query
from sluice.plans.tables import table
from sluice.session import scratch_path

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
ITEM_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*ORDER_COLUMNS.split(", "))


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*ITEM_COLUMNS.split(", "))


@query(
    f"""select {ORDER_COLUMNS} from orders where o_orderstatus <> 'P'
    union all by name select o_custkey, o_orderkey, o_totalprice, 'new' as o_orderpriority
    from orders where o_orderstatus = 'P'"""
)
def load_append(spark: SparkSession, sf: str) -> DataFrame:
    """Append rows in another column order and without two of the columns."""
    orders = _orders(spark, sf)
    source = orders.filter("o_orderstatus = 'P'").select("o_custkey", "o_orderkey", "o_totalprice")
    target = orders.filter("o_orderstatus <> 'P'")
    return load.append_rows(target, source, {"o_orderpriority": "new"})


@query(
    """select o_orderkey, o_custkey, null::varchar as o_orderstatus, o_totalprice,
    null::timestamp as o_orderdate, o_orderpriority from orders"""
)
def load_replace(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf)
    source = orders.select("o_orderpriority", "o_totalprice", "o_custkey", "o_orderkey")
    return load.replace_rows(orders, source)


ORDER_SOURCE = """select o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 as o_totalprice,
  o_orderdate, o_orderpriority from orders where o_orderdate >= '1998-01-01'
  union all select -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority from orders where o_orderstatus = 'P'"""


def _order_source(spark: SparkSession, sf: str) -> DataFrame:
    """Changed recent orders and some under keys the target does not have."""
    orders = _orders(spark, sf)
    changed = orders.filter("o_orderdate >= '1998-01-01'").withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    fresh = orders.filter("o_orderstatus = 'P'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return changed.unionByName(fresh)


@query(
    f"""with src as ({ORDER_SOURCE})
    select {ORDER_COLUMNS} from orders t
    where not exists (select 1 from src s where s.o_orderkey = t.o_orderkey)
    union all select {ORDER_COLUMNS} from src"""
)
def load_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return load.upsert_rows(_orders(spark, sf), _order_source(spark, sf), ["o_orderkey"])


@query(
    f"""with src as ({ORDER_SOURCE})
    select {ORDER_COLUMNS} from orders t
    where not exists (select 1 from src s where s.o_orderkey = t.o_orderkey)
    union all select {ORDER_COLUMNS} from src"""
)
def load_upsert_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert into a folder partitioned by year, of which only touched years are replaced."""
    by_year = F.year("o_orderdate").alias("year")
    path = scratch_path(spark, "orders-by-year")
    _orders(spark, sf).select("*", by_year).repartition("year").write.partitionBy("year").parquet(path)
    load.upsert_partitions(_order_source(spark, sf).select("*", by_year), path, ["o_orderkey"], ["year"])
    return spark.read.parquet(path).selectExpr(*ORDER_COLUMNS.split(", "))


@query(
    f"""with src as (select * replace (0.0::double as l_discount) from lineitem
      where l_returnflag = 'R')
    select {ITEM_COLUMNS} from lineitem t where not exists (select 1 from src s
      where s.l_orderkey = t.l_orderkey and s.l_linenumber = t.l_linenumber)
    union all select {ITEM_COLUMNS} from src"""
)
def load_upsert_dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides repeat keys: all target rows of a key go, all source rows come in."""
    items = _items(spark, sf)
    source = items.filter("l_returnflag = 'R'").withColumn("l_discount", F.lit(0.0))
    return load.upsert_rows(items, source, ["l_orderkey", "l_linenumber"])


@query(
    """with src as (select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
      where l_shipdate >= '2000-01-01')
    select t.* from lineitem t where not exists (select 1 from src s
      where s.l_orderkey = t.l_orderkey and s.l_linenumber = t.l_linenumber)
    union all by name select *, 0.5::double as l_tax from src"""
)
def load_upsert_partial_cols(spark: SparkSession, sf: str) -> DataFrame:
    """Columns the source lacks become default or null, for known keys too."""
    items = _items(spark, sf)
    source = items.filter("l_shipdate >= '2000-01-01'").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    keys = ["l_orderkey", "l_linenumber"]
    return load.upsert_rows(items, source, keys, {"l_tax": 0.5})


@query(
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    nullif(replace(o_orderpriority, '5-LOW', ''), '') as o_orderpriority from orders"""
)
def load_empty_as_null(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf)
    emptied = F.replace("o_orderpriority", F.lit("5-LOW"), F.lit(""))
    return load.replace_rows(orders, orders.withColumn("o_orderpriority", emptied))


@query(
    f"""with src as ({ORDER_SOURCE}),
    n as (select (select count(*) from src) as came, (select count(*) from orders) as before,
      (select count(*) from orders where o_orderkey in (select o_orderkey from src)) as gone)
    select 'append' as how, came as rows_in, 0::bigint as rows_deleted, before + came as rows_after
      from n
    union all select 'replace', came, before, came from n
    union all select 'upsert', came, gone, before - gone + came from n"""
)
def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    orders, source = _orders(spark, sf), _order_source(spark, sf)
    rows = [
        load.load_summary(orders, source, how, ["o_orderkey"] if how == "upsert" else None)
        for how in load.MODES
    ]
    return rows[0].union(rows[1]).union(rows[2])
