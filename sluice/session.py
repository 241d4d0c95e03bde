"""Session builder and the shared scratch folder of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    app: str = "sluice", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with UTC times, Arrow transfer and adaptive execution.

    The number of shuffle partitions is left to the cluster's own setting; pass
    it in ``conf`` for local runs.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, read from ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets a temporary folder
    of its own.  On a cluster a machine-local folder would lose data with its
    executor, so the setting is required there.
    """
    context = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        path = tempfile.mkdtemp(prefix="sluice-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return context.getCheckpointDir() if not spark.conf.get(CHECKPOINT_CONF, None) else path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that lost executors cost no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as parquet in the shared folder: several steps read it, and it is made once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
