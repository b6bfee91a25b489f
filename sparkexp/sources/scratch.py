"""Intermediate tables that outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a session that
    runs inside one local process, as in tests, gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.split("[")[0] == "local":
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    folder = tempfile.mkdtemp(prefix="sparkexp-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/sparkexp/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    With ``partition_by`` each value of that column gets a folder.
    """
    path = scratch_path(df.sparkSession, label)
    return stored_at(df, path, partition_by), path


def stored_at(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the path and read it back."""
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    # With the schema given, a table without rows reads back as well, and no file is opened to learn it.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table made by :func:`materialize`."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
