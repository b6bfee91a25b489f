"""Running totals over a whole table, without gathering the table in one task.

A window that orders a table but does not partition it sends every row to a
single task. Here the rows carry a ``bucket`` number that never decreases
along the order. Spark sums within each bucket in parallel; the bucket totals,
a few thousand rows at most, give each bucket its starting value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_totals(
    rows: DataFrame,
    *,
    bucket: str,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    lead: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_x`` (inclusive running sum) and ``total_x`` for every ``x`` in ``sums``.

    Also adds ``next_y``, the value in the next row, for every ``y`` in
    ``lead``. Values of ``order`` must be distinct within each group of ``by``,
    and ``bucket`` must not be null.
    """

    def along(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    # A struct never is null itself, so a plain join also matches groups whose key is null.
    group = ["_group"] if by else []
    keyed = rows.withColumn("_group", F.struct(*by)) if by else rows
    # Without this Spark would filter nulls on one side of the join only, and
    # then compute ``rows`` twice rather than reuse its shuffle.
    keyed = keyed.withColumn(bucket, F.coalesce(bucket, F.lit(-1)))
    part = [*group, bucket]

    in_bucket = Window.partitionBy(*part).orderBy(along(order))
    so_far = in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = keyed.select(
        "*",
        *[F.sum(x).over(so_far).alias(f"_cum_{x}") for x in sums],
        *[F.lead(y).over(in_bucket).alias(f"_next_{y}") for y in lead],
    )

    first = F.max_by if descending else F.min_by
    totals = keyed.groupBy(*part).agg(
        *[F.sum(x).alias(f"_sum_{x}") for x in sums],
        *[first(y, order).alias(f"_first_{y}") for y in lead],
    )
    over_buckets = Window.partitionBy(*group).orderBy(along(bucket))
    earlier = over_buckets.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *part,
        *[F.coalesce(F.sum(f"_sum_{x}").over(earlier), F.lit(0)).alias(f"_before_{x}") for x in sums],
        *[F.sum(f"_sum_{x}").over(Window.partitionBy(*group)).alias(f"total_{x}") for x in sums],
        *[F.lead(f"_first_{y}").over(over_buckets).alias(f"_following_{y}") for y in lead],
    )

    # Both sides are laid out by bucket, so the join moves no rows of ``local`` again.
    joined = local.join(offsets, part)
    return joined.select(
        *rows.columns,
        *[(F.col(f"_cum_{x}") + F.col(f"_before_{x}")).alias(f"cum_{x}") for x in sums],
        *[f"total_{x}" for x in sums],
        *[F.coalesce(f"_next_{y}", f"_following_{y}").alias(f"next_{y}") for y in lead],
    )
