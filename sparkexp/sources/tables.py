"""Labelled tables, predictions and metrics as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sparkexp.sources.publish import replace

# Types that folder names alone would not give back.
FOLDER_TYPES = {"experiment_id": StringType(), "batch_id": LongType()}


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a Parquet table, or only some of its columns."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def write_table(df: DataFrame, path: str) -> str:
    """Write a new Parquet table; an existing one is never overwritten."""
    df.write.mode("errorifexists").parquet(path)
    return path


def table_shape(df: DataFrame) -> DataFrame:
    """One row with the number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("long")
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first few rows."""
    return df.limit(rows)


def write_predictions(
    predictions: DataFrame,
    path: str,
    *,
    by: Sequence[str] = (),
    batch_column: str = "batch_id",
    batch_folders: bool = False,
) -> str:
    """Write scored rows, replacing everything an earlier run left under ``path``.

    The whole sub-path is overwritten rather than single partitions, so that a
    rerun with fewer batches leaves no old batch behind. The batch is an ordinary
    column and rows are written where they are. With ``batch_folders`` each batch
    gets a folder of its own, which takes a shuffle. Both read back with the same
    columns and types. What was there stays readable until all is written.
    """
    folders = list(by)
    if batch_folders:
        folders.append(batch_column)
        predictions = predictions.hint("rebalance", *folders)
    writer = predictions.write.partitionBy(*folders) if folders else predictions.write
    return replace(predictions.sparkSession, path, writer.parquet)


def read_predictions(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    """Read all scored rows below ``path`` as one table.

    With ``base_path``, the folder names between it and ``path`` become columns
    again. ``experiment_id`` stays text although it looks like a number, and
    ``batch_id`` is long, whether it was a folder or a column.
    """
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    found = reader.parquet(path).schema
    typed = StructType([StructField(f.name, FOLDER_TYPES.get(f.name, f.dataType)) for f in found.fields])
    return reader.schema(typed).parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> str:
    """Write a small result table, replacing an earlier one once all is written."""
    return replace(metrics.sparkSession, path, metrics.write.parquet)
