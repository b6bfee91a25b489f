"""Binary-classification metrics and curves, exact, for tables of any size.

All of them rest on one table: for each distinct score, how many positive and
negative rows have it. Building it combines rows before the shuffle, so a
score shared by a third of all rows costs no more than any other.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import FloatType

from sparkexp.config import SCORE_COLUMN
from sparkexp.functions.columns import col, is_finite
from sparkexp.operators.prefix import running_totals

# How many distinct scores one bucket of the running totals should hold at most.
ROWS_PER_BUCKET = 500_000
# Detail of the sketch that places the edges: ranks are off by some hundred-thousandths of the rows.
SKETCH_DETAIL = 32_768

# The distance from 1 to the next number, for the two score types.
EPSILON_FLOAT = 2.0**-23
EPSILON_DOUBLE = 2.0**-52

BUCKET = "_bucket"


def score_epsilon(df: DataFrame, score: str) -> float:
    """How far log loss keeps scores away from 0 and 1; it depends on their type."""
    return EPSILON_FLOAT if isinstance(df.schema[score].dataType, FloatType) else EPSILON_DOUBLE


def _labelled(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    return df.select(
        *[col(b) for b in by],
        col(label).cast("boolean").alias("_label"),
        col(score).cast("double").alias("score"),
    )


def score_groups(df: DataFrame, label: str, score: str = SCORE_COLUMN, by: Sequence[str] = ()) -> DataFrame:
    """Positives ``p`` and negatives ``n`` of each distinct score, and ``bad`` rows without label or finite score."""
    usable = F.col("_label").isNotNull() & is_finite(F.col("score"))
    return (
        _labelled(df, label, score, by)
        .groupBy(*by, "score")
        .agg(
            F.count_if(usable & F.col("_label")).alias("p"),
            F.count_if(usable & ~F.col("_label")).alias("n"),
            F.count_if(~usable).alias("bad"),
        )
    )


def bucket_edges(df: DataFrame, score: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> list[float]:
    """Edges that cut the scores into buckets of about equal size.

    The edges only decide how the work is divided; results are exact for any
    edges. One pass takes the number of rows and a quantile sketch of fixed
    size, and the edges are read from the sketch. Between two edges there are about
    ``rows_per_bucket`` rows, so at most about as many distinct scores, however
    often a single score repeats. The number of buckets follows the rows, up to
    what the sketch can tell apart (tens of thousands).
    """
    number = F.when(is_finite(F.col("_score")), F.col("_score"))
    seen = df.select(col(score).cast("double").alias("_score")).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double(number, F.lit(SKETCH_DETAIL)).alias("sketch"), F.count(number).alias("usable")
    ).first()
    wanted = math.ceil(seen.rows / rows_per_bucket)
    inner: list[float] = [0.0]
    if wanted > 1 and seen.usable:
        places = F.from_json(F.lit(json.dumps([i / wanted for i in range(1, wanted)])), "array<double>")
        found = F.kll_sketch_get_quantile_double(F.lit(bytes(seen.sketch)), places)
        inner = sorted(set(df.sparkSession.range(1).select(found.alias("edges")).first().edges))
    return [-float("inf"), *inner, float("inf")]


def with_buckets(groups: DataFrame, edges: Sequence[float]) -> DataFrame:
    """Number the groups by score bucket; groups without a finite score get the lowest number."""
    usable = is_finite(F.col("score"))
    placed = Bucketizer(splits=list(edges), inputCol="_safe", outputCol="_placed", handleInvalid="keep").transform(
        groups.withColumn("_safe", F.when(usable, F.col("score")).otherwise(F.lit(0.0)))
    )
    return placed.withColumn(BUCKET, F.when(usable, F.col("_placed").cast("int")).otherwise(F.lit(-1))).drop(
        "_safe", "_placed"
    )


def ranked_groups(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    lead: Sequence[str] = (),
) -> DataFrame:
    """The score groups with running counts from the highest score down."""
    edges = bucket_edges(df, score, rows_per_bucket)
    bucketed = with_buckets(score_groups(df, label, score, by), edges)
    return running_totals(
        bucketed, bucket=BUCKET, order="score", sums=["p", "n", "bad"], by=by, descending=True, lead=lead
    )


def _clipped(score: Column, epsilon: float) -> Column:
    return F.least(F.greatest(score, F.lit(epsilon)), F.lit(1.0 - epsilon))


def _log_loss_or_null(total: Column, positives: Column, negatives: Column, bad: Column, outside: Column) -> Column:
    """The mean, or null with one class only, an unusable row or a score that is no probability."""
    valid = (bad == 0) & (outside == 0) & (positives > 0) & (negatives > 0)
    return F.when(valid, total / (positives + negatives))


def log_loss(df: DataFrame, label: str, score: str = SCORE_COLUMN, by: Sequence[str] = ()) -> DataFrame:
    """Log loss with natural logarithm, in one pass over the rows."""
    epsilon = score_epsilon(df, score)
    usable = F.col("_label").isNotNull() & is_finite(F.col("score"))
    safe = _clipped(F.col("score"), epsilon)
    loss = -F.when(F.col("_label"), F.ln(safe)).otherwise(F.ln(1 - safe))
    return (
        _labelled(df, label, score, by)
        .groupBy(*by)
        .agg(
            F.sum(F.when(usable, loss)).alias("loss"),
            F.count_if(usable & F.col("_label")).alias("p"),
            F.count_if(usable & ~F.col("_label")).alias("n"),
            F.count_if(~usable).alias("bad"),
            F.count_if(usable & ~F.col("score").between(0.0, 1.0)).alias("outside"),
        )
        .select(
            *by, _log_loss_or_null(*[F.col(c) for c in ("loss", "p", "n", "bad", "outside")]).alias("logloss")
        )
    )


def metrics_from_ranked(ranked: DataFrame, epsilon: float, by: Sequence[str] = ()) -> DataFrame:
    """Log loss, area under the ROC curve and average precision from ranked score groups."""
    p, n, tp, fp = F.col("p"), F.col("n"), F.col("cum_p"), F.col("cum_n")
    safe = _clipped(F.col("score"), epsilon)
    outside = (p + n > 0) & ~F.col("score").between(0.0, 1.0)
    sums = ranked.groupBy(*by).agg(
        F.sum(F.when(p + n > 0, -(p * F.ln(safe) + n * F.ln(1 - safe)))).alias("loss"),
        F.sum(n * (tp - p / 2)).alias("area"),
        F.sum(p * F.try_divide(tp, tp + fp)).alias("precision_sum"),
        F.sum("p").alias("p"),
        F.sum("n").alias("n"),
        # The last running count is the total. Taking it from there makes both inputs of
        # the join in running_totals need the same columns, so Spark scans only once.
        F.max("cum_bad").alias("bad"),
        F.count_if(outside).alias("outside"),
    )
    clean = F.col("bad") == 0
    weight = F.col("p").cast("double") * F.col("n")
    return sums.select(
        *by,
        _log_loss_or_null(*[F.col(c) for c in ("loss", "p", "n", "bad", "outside")]).alias("logloss"),
        F.when(clean, F.try_divide(F.col("area"), weight)).alias("auc"),
        F.when(
            clean, F.when(F.col("p") == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("precision_sum"), F.col("p")))
        ).alias("auprc"),
    )


def binary_metrics(
    df: DataFrame,
    label: str,
    score: str = SCORE_COLUMN,
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``logloss``, ``auc`` and ``auprc``, one row for each group of ``by``; a metric that is undefined is null."""
    ranked = ranked_groups(df, label, score, by, rows_per_bucket)
    return metrics_from_ranked(ranked, score_epsilon(df, score), by)


def roc_auc(df: DataFrame, label: str, score: str = SCORE_COLUMN, by: Sequence[str] = (), **options) -> DataFrame:
    """Area under the ROC curve, tied scores at half weight."""
    return binary_metrics(df, label, score, by, **options).select(*by, "auc")


def average_precision(
    df: DataFrame, label: str, score: str = SCORE_COLUMN, by: Sequence[str] = (), **options
) -> DataFrame:
    """Average precision as a step sum over the distinct scores."""
    return binary_metrics(df, label, score, by, **options).select(*by, "auprc")


def curve_from_ranked(ranked: DataFrame, by: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """ROC points from ranked score groups that carry ``next_p`` and ``next_n``."""
    tp, fp = F.col("cum_p"), F.col("cum_n")
    points = ranked.where(F.col("p") + F.col("n") > 0)
    first = tp + fp == F.col("p") + F.col("n")
    if drop_intermediate:
        last = tp + fp == F.col("total_p") + F.col("total_n")
        bend = (F.col("next_p") != F.col("p")) | (F.col("next_n") != F.col("n"))
        points = points.where(first | last | bend)
    # The second condition follows from the first; it lets Spark scan only once, as in metrics_from_ranked.
    clean = (F.col("total_bad") == 0) & (F.col("cum_bad") == 0)

    def rate(count: Column, total: str) -> Column:
        return F.when(clean, F.try_divide(count.cast("double"), F.col(total)))

    def point(threshold: Column, false_positives: Column, true_positives: Column) -> Column:
        return F.struct(
            threshold.alias("threshold"),
            rate(false_positives, "total_n").alias("fpr"),
            rate(true_positives, "total_p").alias("tpr"),
        )

    here = point(F.col("score"), fp, tp)
    origin = point(F.lit(float("inf")), F.lit(0), F.lit(0))
    return points.select(*by, F.inline(F.when(first, F.array(origin, here)).otherwise(F.array(here))))


def roc_curve(
    df: DataFrame,
    label: str,
    score: str = SCORE_COLUMN,
    by: Sequence[str] = (),
    drop_intermediate: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``threshold``, ``fpr`` and ``tpr`` for each distinct score, starting from (0, 0) at infinity.

    With ``drop_intermediate``, points on a straight line between their
    neighbours are left out. Rates are null where a class or a value is missing.
    """
    ranked = ranked_groups(df, label, score, by, rows_per_bucket, lead=["p", "n"])
    return curve_from_ranked(ranked, by, drop_intermediate)


def target_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows of class False and True, in this order; a class without rows counts 0, nulls count nowhere."""
    value = col(label).cast("boolean")
    counted = df.agg(F.count_if(~value).alias("negatives"), F.count_if(value).alias("positives"))
    return two_class_rows(counted)


def two_class_rows(counted: DataFrame) -> DataFrame:
    """Turn one row of ``negatives`` and ``positives`` into two."""
    return counted.select(
        F.inline(
            F.array(
                F.struct(F.lit(False).alias("target"), F.col("negatives").alias("row_count")),
                F.struct(F.lit(True).alias("target"), F.col("positives").alias("row_count")),
            )
        )
    )


def class_scores(df: DataFrame, label: str, score: str = SCORE_COLUMN, positive: bool = True) -> DataFrame:
    """The scores of one class."""
    value = col(label).cast("boolean")
    return df.where(value if positive else ~value).select(col(score).alias("score"))
