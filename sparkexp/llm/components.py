"""Connected components of a large graph, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkexp.sources.scratch import discard, materialize

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of the edges ``a``, ``b``.

    Alternates two steps until nothing changes: every node's larger neighbours
    are linked to its smallest one, then its smaller neighbours and itself are.
    Both are minima that Spark aggregates partly before a shuffle, and joins on a
    node, of which Spark splits skewed partitions. Each round is written to the
    shared folder, which cuts the lineage; rounds grow with the logarithm of the
    longest path. Edges with a null end, and from a node to itself, are left out.
    """
    spark = edges.sparkSession
    current = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    current, path = materialize(current.where("a < b").distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Larger neighbours of u move to its least neighbour.
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct()
        # Then, seen from the larger end of each edge, smaller neighbours move to the least of them.
        small = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        moved = large.withColumnRenamed("b", "u").join(small, "u").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        joined = moved.unionByName(small.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()
        following, next_path = materialize(joined, "edges")
        state = following.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        discard(spark, path)
        current, path = following, next_path
        if state == before:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        before = state
    raise RuntimeError(f"Components were not found in {MAX_ROUNDS} rounds.")
