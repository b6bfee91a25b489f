"""Equal-width histograms of the scores of each class."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from sparkexp.config import SCORE_COLUMN
from sparkexp.functions.columns import col

BINS = 50


@dataclass(frozen=True)
class BinRange:
    """The range a histogram covers, and its edges."""

    low: float
    high: float
    bins: int = BINS

    @classmethod
    def around(cls, low: float | None, high: float | None, bins: int = BINS) -> BinRange:
        """The range from the smallest to the largest value; no values give [0, 1], one value a width of 1."""
        if low is None or high is None:
            return cls(0.0, 1.0, bins)
        if not (math.isfinite(low) and math.isfinite(high)):
            raise ValueError("A histogram needs finite scores.")
        if low == high:
            return cls(low - 0.5, high + 0.5, bins)
        return cls(float(low), float(high), bins)

    def edge(self, index: Column) -> Column:
        inner = F.lit(self.low) + index * F.lit((self.high - self.low) / self.bins)
        return F.when(index >= self.bins, F.lit(self.high)).otherwise(inner)

    def bin_of(self, value: Column) -> Column:
        """The bin of a value. A quotient that rounding put on the wrong side of an edge is moved by one."""
        last = F.lit(self.bins - 1)
        share = (value - F.lit(self.low)) / F.lit(self.high - self.low)
        guess = F.least(last, F.floor(share * self.bins).cast("int"))
        too_high = value < self.edge(guess)
        too_low = (value >= self.edge(guess + 1)) & (guess != last)
        return F.when(too_high, guess - 1).when(too_low, guess + 1).otherwise(guess)


def class_histograms(
    df: DataFrame,
    label: str,
    score: str = SCORE_COLUMN,
    bins: int = BINS,
) -> DataFrame:
    """``target, bin, low_edge, high_edge, row_count`` for both classes, bins without rows included.

    One job finds the range of each class, four numbers. The result then takes
    one pass with a partial sum for each bin, so no class or bin can be too big.
    """
    rows = df.select(
        col(label).cast("boolean").alias("target"), col(score).cast("double").alias("score"), F.lit(1).alias("weight")
    ).where(F.col("target").isNotNull())
    negative, positive, value = ~F.col("target"), F.col("target"), F.col("score")
    found = rows.agg(*range_columns(negative, positive, value), F.count_if(value.isNull()).alias("missing")).first()
    if found.missing:
        raise ValueError("A histogram needs finite scores.")
    return weighted_histograms(rows, *class_ranges(found, bins))


def range_columns(negative: Column, positive: Column, value: Column) -> list[Column]:
    """Aggregates for the smallest and largest value of each class."""
    return [
        F.min(F.when(negative, value)).alias("low_neg"),
        F.max(F.when(negative, value)).alias("high_neg"),
        F.min(F.when(positive, value)).alias("low_pos"),
        F.max(F.when(positive, value)).alias("high_pos"),
    ]


def class_ranges(found: Row, bins: int = BINS) -> tuple[BinRange, BinRange]:
    """The histogram ranges of both classes, from one row of :func:`range_columns`."""
    return (
        BinRange.around(found.low_neg, found.high_neg, bins),
        BinRange.around(found.low_pos, found.high_pos, bins),
    )


def weighted_histograms(rows: DataFrame, negatives: BinRange, positives: BinRange) -> DataFrame:
    """Both histograms from rows ``target, score, weight``, where a row may stand for several."""
    positive, value, bins = F.col("target"), F.col("score"), negatives.bins
    counted = rows.select(
        "target",
        F.when(positive, positives.bin_of(value)).otherwise(negatives.bin_of(value)).alias("bin"),
        F.col("weight").cast("long").alias("weight"),
    )
    empty = rows.sparkSession.range(2 * bins).select(
        (F.col("id") >= bins).alias("target"),
        F.pmod("id", F.lit(bins)).cast("int").alias("bin"),
        F.lit(0).cast("long").alias("weight"),
    )
    index = F.col("bin")
    return (
        counted.unionByName(empty)
        .groupBy("target", "bin")
        .agg(F.sum("weight").alias("row_count"))
        .select(
            "target",
            "bin",
            F.when(positive, positives.edge(index)).otherwise(negatives.edge(index)).alias("low_edge"),
            F.when(positive, positives.edge(index + 1)).otherwise(negatives.edge(index + 1)).alias("high_edge"),
            "row_count",
        )
    )


def score_histogram(
    df: DataFrame, label: str, score: str = SCORE_COLUMN, positive: bool = True, bins: int = BINS
) -> DataFrame:
    """The histogram of one class."""
    value = col(label).cast("boolean")
    return class_histograms(df.where(value if positive else ~value), label, score, bins).where(
        F.col("target") == F.lit(positive)
    )
