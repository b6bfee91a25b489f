"""Dividing a table into repeatable batches, and the ledger of what each batch holds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkexp.config import SCORE_COLUMN
from sparkexp.functions.columns import col, key_hash
from sparkexp.operators.prefix import running_totals
from sparkexp.sources.scratch import scratch_path, stored_at

# Batch ids in one bucket of the ledger's running total.
LEDGER_BUCKET = 50_000
# Values whose rows a task numbers at once; the section stands above these bits of a row's place, its number below.
SECTION_VALUES = 100_000
PLACE_BITS = 40


def num_batches(rows: int, batch_size: int) -> int:
    """How many batches of about ``batch_size`` rows the table needs."""
    if batch_size <= 0:
        raise ValueError(f"A batch cannot hold {batch_size} rows.")
    return -(-rows // batch_size)


def num_batches_table(df: DataFrame, batch_size: int) -> DataFrame:
    """One row with the number of rows, the batch size and the number of batches."""
    num_batches(0, batch_size)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(batch_size).cast("long").alias("batch_size"),
        F.ceil(F.col("row_count") / F.lit(batch_size)).cast("long").alias("num_batches"),
    )


def batch_of(keys: Sequence[str], batches: int | Column, seed: int = 42) -> Column:
    """The batch of a row, from its key values and the seed alone."""
    return batch_of_hash(key_hash(keys, seed), batches)


def batch_of_hash(number: Column, batches: int | Column) -> Column:
    """The batch of a row whose key hash is known."""
    count = batches if isinstance(batches, Column) else F.lit(batches).cast("long")
    return F.pmod(number, count)


def assign_batches(
    df: DataFrame,
    key: Sequence[str] | str | None,
    batch_size: int = 1000,
    seed: int = 42,
    batches: int | None = None,
    column: str = "batch_id",
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Add the batch of each row. Batches are disjoint, cover the table and are about equal in size.

    A row keeps its batch however the table is laid out or recomputed, which a
    random split does not promise. Rows with equal ``key`` are told apart by the
    columns in ``spread`` (by default all others), so that a key with very many
    rows fills no batch by itself; only rows that are equal in all of these share
    one. The table is counted unless ``batches`` is given.
    """
    if batches is None:
        batches = num_batches(df.count(), batch_size)
    return df.withColumn(column, batch_of(telling_columns(df, key, spread), max(batches, 1), seed))


def deal_batches(
    df: DataFrame,
    key: Sequence[str] | str | None,
    batches: int,
    seed: int = 42,
    column: str = "batch_id",
    spread: Sequence[str] | None = None,
    repeated_from: int = 1,
) -> tuple[DataFrame, str]:
    """Like :func:`assign_batches`, but equal rows are dealt one by one, so no row value fills a batch by itself.

    Rows with equal key and ``spread`` are numbered, and the number is added to their hash. That takes their place in a
    stored copy of the table: each task numbers its equal rows as it writes them, in sections of a bounded number of
    values, and the sections' counts are summed up, so rows are neither moved nor sorted and no value's rows meet in one
    task. Only values with more than ``repeated_from`` rows are treated so. Returns the table, which reads the copy, and the copy's path.
    """
    number = f"{column}_hash"

    @F.pandas_udf("long")
    def place(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen, section = {}, 0
        for batch in values:
            group, found = pd.factorize(batch)
            before = np.array([seen.get(value, 0) for value in found], np.int64)
            yield (section << PLACE_BITS) + before[group] + batch.groupby(group).cumcount()
            seen.update(zip(found, before + np.bincount(group, minlength=len(found))))
            if len(seen) > SECTION_VALUES:
                seen, section = {}, section + 1

    hashed = df.withColumn(number, key_hash(telling_columns(df, key, spread), seed))
    path = scratch_path(df.sparkSession, "dealt")
    stored = stored_at(hashed.select("*", place.asNondeterministic()(number).alias("_place"), F.spark_partition_id().alias("_task")), f"{path}/rows")
    section = ["_task", "_section"]
    placed = stored.withColumn("_section", F.shiftright("_place", PLACE_BITS))
    counts = placed.groupBy(number, *section).agg(F.count(F.lit(1)).alias("_n"))
    value = Window.partitionBy(number)
    earlier = F.sum("_n").over(value.orderBy(*section).rowsBetween(Window.unboundedPreceding, -1))
    summed = counts.withColumn("_before", F.coalesce(earlier, F.lit(0))).withColumn("_copies", F.sum("_n").over(value))
    repeated = summed.where(F.col("_copies") > repeated_from).select(number, *section, "_before")
    # Stored, so that Spark knows that it is small before it plans to move the rows.
    marked = placed.join(stored_at(repeated, f"{path}/repeated"), [number, *section], "left")
    in_section = F.col("_place").bitwiseAND((1 << PLACE_BITS) - 1)
    occurrence = F.coalesce(F.col("_before") + in_section, F.lit(0))
    dealt = marked.withColumn(column, batch_of_hash(F.col(number) + occurrence, max(1, batches)))
    return dealt.select(*[col(name) for name in df.columns if name != column], column), path


def telling_columns(
    df: DataFrame, key: Sequence[str] | str | None, spread: Sequence[str] | None = None
) -> list[str]:
    """The key's columns, then those that tell rows of equal key apart."""
    keys = [] if not key else [key] if isinstance(key, str) else list(key)
    others = df.columns if spread is None else spread
    return keys + [name for name in others if name not in keys]


# Columns that scoring adds; they never tell rows apart.
RESERVED = ("batch_id", "prefix", "experiment_id")


def batch_columns(
    df: DataFrame, key: Sequence[str] | str | None, predictors: Sequence[str], spread: Sequence[str] | None = None, score: str = SCORE_COLUMN
) -> list[str]:
    """The columns from which training and scoring alike derive a row's batch.

    With a key, the key and then ``spread`` (by default the predictors), so that a key with very
    many rows fills no batch by itself. Without one, all columns but those that scoring adds.
    """
    if not key and spread is None:
        return [name for name in df.columns if name not in (*RESERVED, score)]
    return telling_columns(df, key, predictors if spread is None else spread)


def batch_ledger(df: DataFrame, target: str, batch_column: str = "batch_id") -> DataFrame:
    """Rows, positives and negatives of each batch, with the running row count and the percentage done.

    The running totals and their bucket sums share one shuffle of the counts, so the table is read once.
    """
    label = col(target).cast("boolean")
    batches = (
        df.groupBy(batch_column)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(label).alias("positives"),
            F.count_if(~label).alias("negatives"),
        )
        .withColumn("_bucket", F.floor(F.col(batch_column) / LEDGER_BUCKET))
    )
    running = running_totals(batches, bucket="_bucket", order=batch_column, sums=["row_count"])
    return running.select(
        batch_column,
        "row_count",
        "positives",
        "negatives",
        F.col("cum_row_count").alias("running_rows"),
        (F.col("cum_row_count") / F.col("total_row_count") * 100).alias("percent_done"),
    )
