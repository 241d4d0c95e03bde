"""Loading rows into a table: append, replace, upsert, and truncate-and-fill.

The row functions (``append_rows`` …) say what a table holds after a load and are
lazy; ``load_table`` runs one against a catalog table.  An upsert deletes every
target row whose key occurs in the source and then adds *all* source rows, so
repeated source keys are all kept, null keys delete nothing, and columns the
source lacks go to their default even for keys that were there before.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.cells import empty_as_null
from sluice.operators.typing import name_of
from sluice.session import cut_lineage, scratch_path

MODES = ("append", "replace", "upsert")
# Partitions whose values are written into a filter, and tasks that write one partition.
LISTED_PARTITIONS = 1_000
FILES_PER_PARTITION = 8


def check_load(how: str, keys: list[str] | None) -> None:
    if how not in MODES:
        raise ValueError(f"how must be one of {MODES}, not {how!r}")
    if (how == "upsert") != bool(keys):
        raise ValueError("keys are required for an upsert and only allowed there")


def blanks_as_null(df: DataFrame) -> DataFrame:
    """Empty strings become null in every text column."""
    return df.select(
        *[
            empty_as_null(F.col(name_of(f.name))).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(name_of(f.name))
            for f in df.schema
        ]
    )


def named_for(source: DataFrame, schema: T.StructType) -> DataFrame:
    """Source columns in the target's types; a column the target lacks is an error."""
    types = {f.name: f.dataType for f in schema}
    unknown = [c for c in source.columns if c not in types]
    if unknown:
        raise ValueError(f"columns unknown to the target: {unknown}")
    return blanks_as_null(source).select(
        *[F.col(name_of(c)).cast(types[c]).alias(c) for c in source.columns]
    )


def aligned_to(
    source: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None
) -> DataFrame:
    """Source rows with exactly the target's columns; absent ones get their default."""
    rows = named_for(source, schema)
    defaults = defaults or {}
    return rows.select(
        *[
            F.col(name_of(f.name))
            if f.name in rows.columns
            else F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def append_rows(
    target: DataFrame, source: DataFrame, defaults: dict[str, object] | None = None
) -> DataFrame:
    return target.unionByName(aligned_to(source, target.schema, defaults))


def replace_rows(
    target: DataFrame, source: DataFrame, defaults: dict[str, object] | None = None
) -> DataFrame:
    return aligned_to(source, target.schema, defaults)


def rows_kept(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not in the source; null keys never match."""
    return target.join(source.select(*keys).distinct(), keys, "left_anti").select(target.columns)


def upsert_rows(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    rows = aligned_to(source, target.schema, defaults)
    return rows_kept(target, rows, keys).unionByName(rows)


def load_rows(
    target: DataFrame,
    source: DataFrame,
    how: str = "append",
    keys: list[str] | None = None,
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """The target after the load."""
    check_load(how, keys)
    if how == "append":
        return append_rows(target, source, defaults)
    if how == "replace":
        return replace_rows(target, source, defaults)
    return upsert_rows(target, source, keys, defaults)


def load_summary(
    target: DataFrame, source: DataFrame, how: str, keys: list[str] | None = None
) -> DataFrame:
    """One row on what a load does: rows in, rows deleted and rows after it."""
    check_load(how, keys)
    rows = aligned_to(source, target.schema)
    kept = {
        "append": lambda: target,
        "replace": lambda: target.limit(0),
        "upsert": lambda: rows_kept(target, rows, keys),
    }[how]()
    before, after, came = (
        df.agg(F.count("*").alias("n")).scalar() for df in (target, kept, rows)
    )
    return target.sparkSession.range(1).select(
        F.lit(how).alias("how"),
        came.alias("rows_in"),
        (before - after).alias("rows_deleted"),
        (after + came).alias("rows_after"),
    )


def load_table(
    source: DataFrame,
    table: str,
    how: str = "append",
    keys: list[str] | None = None,
) -> dict[str, object]:
    """Load ``source`` into a catalog table and return what was done.

    An append inserts the source as it comes.  Replace and upsert read it twice, so it is
    staged once in the shared folder, and the copy is removed at the end.  They fill a new
    table like the target, which then takes the target's name: a load that fails leaves the
    target as it was.  Columns the source lacks get the default declared on the table.
    """
    check_load(how, keys)
    spark = source.sparkSession
    target = spark.table(table)
    rows = named_for(source, target.schema)
    before = target.count()
    if how == "append":
        _insert(spark, table, rows)
        after = spark.table(table).count()
        return _done(table, how, after - before, 0, after)
    path = scratch_path(spark, "stage")
    fresh = f"{table}__{uuid.uuid4().hex[:12]}"
    try:
        rows.write.parquet(path)
        staged = spark.read.schema(rows.schema).parquet(path)
        spark.sql(f"CREATE TABLE {fresh} LIKE {table} USING {_provider(spark, table)}")
        if how == "upsert":
            _insert(spark, fresh, rows_kept(target, staged, keys))
        kept = spark.table(fresh).count()
        _insert(spark, fresh, staged)
        came = staged.count()
        _swap(spark, table, fresh)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        remove(spark, path)
    return _done(table, how, came, before - kept, kept + came)


def upsert_partitions(
    source: DataFrame,
    path: str,
    keys: list[str],
    partitions: list[str],
    defaults: dict[str, object] | None = None,
) -> dict[str, object]:
    """Upsert into a folder of parquet files partitioned by ``partitions``; files of other partitions are left alone.

    Touched are the partitions that hold a key of the source, or that a source row goes to.  If the
    partition columns are part of the key, the source alone says which; else the key columns of the target are
    read.  Only the touched ones are read whole and replaced, by dynamic partition overwrite, from a result that
    is complete in the shared folder by then.  A key that has moved may empty its old partition, which is removed last; the
    same upsert run again after a failure between the two gives the same rows.
    """
    check_load("upsert", keys)
    spark = source.sparkSession
    target = spark.read.parquet(path)
    rows = named_for(source, target.schema)
    before = target.count()
    stage, result = scratch_path(spark, "stage"), scratch_path(spark, "partitions")
    try:
        aligned_to(rows, target.schema, defaults).write.parquet(stage)
        staged = spark.read.schema(target.schema).parquet(stage)
        wanted = staged.select(*keys).distinct()
        into = staged.select(*partitions).distinct()
        if set(partitions) <= set(keys):
            touched = into
        else:
            touched = target.join(wanted, keys, "left_semi").select(*partitions).union(into).distinct()
        touched = cut_lineage(touched)
        affected = _within(target, touched, partitions)
        merged = rows_kept(affected, staged, keys).unionByName(staged)
        merged.repartition(*partitions, F.pmod(F.xxhash64(*keys), F.lit(FILES_PER_PARTITION))).write.partitionBy(*partitions).parquet(result)
        merged = spark.read.schema(target.schema).parquet(result)
        emptied = _folders(affected, partitions, merged.select(*partitions).distinct())
        came, after = staged.count(), merged.count()
        deleted = affected.count() - (after - came)
        merged.write.partitionBy(*partitions).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        for folder in emptied:
            remove(spark, folder)
    finally:
        remove(spark, stage)
        remove(spark, result)
    return _done(path, "upsert", came, deleted, before - deleted + came)


def _same(values: dict[str, object]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name_of(c)).eqNullSafe(F.lit(v)) for c, v in values.items()])


def _within(target: DataFrame, touched: DataFrame, partitions: list[str]) -> DataFrame:
    """The rows of the touched partitions: by a filter that prunes files, or by a join if there are very many."""
    listed = touched.limit(LISTED_PARTITIONS + 1).collect()
    if len(listed) <= LISTED_PARTITIONS:
        any_of = [_same({c: r[c] for c in partitions}) for r in listed]
        return target.filter(reduce(lambda a, b: a | b, any_of) if any_of else F.lit(False))
    own = touched.select(*[F.col(name_of(c)).alias(f"_touched_{c}") for c in partitions])
    same = [F.col(name_of(c)).eqNullSafe(F.col(f"_touched_{c}")) for c in partitions]
    return target.join(own, reduce(lambda a, b: a & b, same), "left_semi")


def _folders(affected: DataFrame, partitions: list[str], filled: DataFrame) -> list[str]:
    """Folders of the affected partitions that are not among ``filled``."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]+$", "")
    held = affected.select(*partitions, folder.alias("_folder")).distinct()
    own = filled.select(*[F.col(name_of(c)).alias(f"_filled_{c}") for c in partitions])
    same = [F.col(name_of(c)).eqNullSafe(F.col(f"_filled_{c}")) for c in partitions]
    # Spark gives the path as a URI, in which special signs are coded.
    jvm = affected.sparkSession.sparkContext._jvm
    found = held.join(own, reduce(lambda a, b: a & b, same), "left_anti").collect()
    return [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["_folder"])).toString() for r in found]


def _done(table: str, how: str, came: int, deleted: int, after: int) -> dict[str, object]:
    return {
        "table": table, "how": how, "rows_in": came, "rows_deleted": deleted, "rows_after": after,
    }


def _swap(spark: SparkSession, table: str, fresh: str) -> None:
    """Give ``fresh`` the name of ``table``; if that fails the table gets its name back."""
    old = f"{table}__{uuid.uuid4().hex[:12]}"
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {old}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def _insert(spark: SparkSession, table: str, rows: DataFrame) -> None:
    spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=rows)


def _provider(spark: SparkSession, table: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return detail.filter(F.col("col_name") == "Provider").first()["data_type"]
