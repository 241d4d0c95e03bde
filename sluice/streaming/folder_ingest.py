"""Repeated ingest of a folder: every file is taken once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch"
AFTER_READ = ("off", "archive", "delete")


def load_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    out: str,
    checkpoint: str,
    name: str,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Append the new files of a folder to a parquet folder exactly once, also when a batch is replayed.

    The rows of a batch are written to a partition of their own, ``batch``, named after the stream and the number that Spark
    gives the batch again on a replay; a replayed batch so replaces what its first try has left.  The partitions are
    the ledger of what was loaded: ``loaded_batches`` lists it.
    """
    if not name.isidentifier():
        raise ValueError("the name of a stream is letters, digits and _")

    def load(rows: DataFrame, number: int) -> None:
        marked = rows.withColumn(BATCH, F.lit(f"{name}_{number:012d}"))
        marked.write.partitionBy(BATCH).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(out)

    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def loaded_batches(spark: SparkSession, out: str) -> DataFrame:
    """``(batch, n)``: the batches that a folder holds, with their rows."""
    return spark.read.parquet(out).groupBy(BATCH).agg(F.count("*").alias("n"))


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    out: str,
    checkpoint: str,
    after_read: str = "off",
    archive: str | None = None,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Append the CSV files that came since the last run to a parquet folder.

    The checkpoint remembers what was read, so a run takes each file once, also
    after a failure.  Files are kept unless ``after_read`` asks to archive or
    delete them; Spark does so once the batch that read them is committed and a
    later batch begins.
    """
    if after_read not in AFTER_READ:
        raise ValueError(f"after_read must be one of {AFTER_READ}")
    if (after_read == "archive") != (archive is not None):
        raise ValueError("an archive folder belongs to after_read='archive'")
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("cleanSource", after_read)
    )
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return (
        reader.csv(folder)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
