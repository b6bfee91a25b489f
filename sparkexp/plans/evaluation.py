"""Evaluating a table of predictions, and the combined report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkexp.config import SCORE_COLUMN, ExperimentPaths
from sparkexp.operators.histogram import BINS, class_ranges, range_columns, weighted_histograms
from sparkexp.operators.metrics import (
    ROWS_PER_BUCKET,
    curve_from_ranked,
    metrics_from_ranked,
    ranked_groups,
    score_epsilon,
    two_class_rows,
)
from sparkexp.plans.together import run_together
from sparkexp.sources.scratch import discard, materialize
from sparkexp.sources.tables import write_metrics

# The text of the error callers match on.
EMPTY_PREDICTIONS = "The predictions_data DataFrame is empty."

TABLES = ("metrics", "roc_curve", "target_counts", "score_histogram")
# The sections of the report, in order.
SECTIONS = {"val": "Validation Report", "test": "Test Report"}
# Fixed value: the section of the spans.
DETAILS = "Experiment Details"


@dataclass(frozen=True)
class Evaluation:
    """The result tables for one part of the data."""

    metrics: DataFrame
    roc_curve: DataFrame
    target_counts: DataFrame
    score_histogram: DataFrame
    # The table behind the results when they are not stored themselves.
    ranked_path: str | None = None

    def close(self) -> None:
        """Remove the intermediate table; results that were not stored cannot be read afterwards."""
        if self.ranked_path:
            discard(self.metrics.sparkSession, self.ranked_path)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}


def evaluate(
    predictions: DataFrame,
    *,
    target_col: str,
    score_col: str = SCORE_COLUMN,
    output: str | None = None,
    bins: int = BINS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Evaluation:
    """Metrics, ROC curve, class counts and score histograms of a table of predictions.

    The classes are counted and ranked at each distinct score, once, and that
    table is kept in the shared folder. Everything else is a single pass over
    it, without a further sort. With ``output``, the results are written below
    that path and the intermediate table is removed; otherwise ``close`` on the result removes it.
    """
    spark = predictions.sparkSession
    epsilon = score_epsilon(predictions, score_col)
    ranked, path = materialize(
        ranked_groups(predictions, target_col, score_col, rows_per_bucket=rows_per_bucket, lead=["p", "n"]), "ranked"
    )
    try:
        return _evaluate_ranked(ranked, path, epsilon, output, bins)
    except BaseException:
        discard(spark, path)
        raise


def _evaluate_ranked(ranked: DataFrame, path: str, epsilon: float, output: str | None, bins: int) -> Evaluation:
    spark = ranked.sparkSession
    totals = ranked.agg(
        F.sum("bad").alias("bad"), *range_columns(F.col("n") > 0, F.col("p") > 0, F.col("score"))
    ).first()
    if totals.bad is None or totals.bad > 0:
        raise ValueError(f"{totals.bad} rows have no label or no score." if totals.bad else EMPTY_PREDICTIONS)
    by_class = ranked.select(
        "score", F.inline(F.array(*[F.struct(F.lit(t).alias("target"), F.col(c).alias("weight")) for t, c in _CLASSES]))
    ).where(F.col("weight") > 0)
    result = Evaluation(
        metrics=metrics_from_ranked(ranked, epsilon),
        roc_curve=curve_from_ranked(ranked),
        target_counts=two_class_rows(ranked.agg(F.sum("n").alias("negatives"), F.sum("p").alias("positives"))),
        score_histogram=weighted_histograms(by_class, *class_ranges(totals, bins)),
        ranked_path=path if output is None else None,
    )
    if output is None:
        return result
    written = write_evaluation(result, output)
    discard(spark, path)
    return written


_CLASSES = ((False, "n"), (True, "p"))


def write_evaluation(result: Evaluation, output: str) -> Evaluation:
    """Write the result tables below ``output`` and return them as read back."""
    spark = result.metrics.sparkSession
    run_together(
        *[partial(write_metrics, table, f"{output}/{name}") for name, table in result.tables().items()]
    )
    return read_evaluation(spark, output)


def read_evaluation(spark: SparkSession, output: str) -> Evaluation:
    """Read the result tables of an earlier evaluation; a missing one raises."""
    return Evaluation(**{name: spark.read.parquet(f"{output}/{name}") for name in TABLES})


def report_table(experiment_id: str, spans: DataFrame, evaluations: Mapping[str, Evaluation]) -> DataFrame:
    """The whole report as one tidy table, ready to plot or to query.

    ``section`` and ``item`` say where a value belongs. ``x`` is its position
    in a curve or histogram, and ``value`` the number itself. ``label`` holds text, such as the
    dates of a period.
    """
    parts = [
        spans.select(
            *_place(DETAILS, F.col("period"), F.lit("size")),
            _number(None, "x"),
            _number(F.col("row_count"), "value"),
            F.concat_ws(" to ", F.date_format("start_date", "yyyy-MM-dd"), F.date_format("end_date", "yyyy-MM-dd")).alias(
                "label"
            ),
        )
    ]
    for prefix, found in evaluations.items():
        section = SECTIONS.get(prefix, "Model Evaluation Report")
        # One scan for all three.
        named = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in ("logloss", "auc", "auprc")])
        listed = found.metrics.select(F.inline(named))
        parts.append(_values(listed, section, F.lit("metrics"), F.col("key"), None, F.col("value")))
        parts.append(
            _values(found.target_counts, section, F.lit("target_counts"), _class_name(), None, F.col("row_count"))
        )
        parts.append(_values(found.roc_curve, section, F.lit("roc_curve"), F.lit("tpr"), F.col("fpr"), F.col("tpr")))
        parts.append(
            _values(
                found.score_histogram,
                section,
                F.lit("score_histogram"),
                _class_name(),
                F.col("low_edge"),
                F.col("row_count"),
            )
        )
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table.select(F.lit(experiment_id).alias("experiment_id"), *table.columns)


def _class_name() -> Column:
    return F.when(F.col("target"), F.lit("True")).otherwise(F.lit("False"))


def _place(section: str, item: Column, key: Column) -> list[Column]:
    return [F.lit(section).alias("section"), item.alias("item"), key.alias("key")]


def _number(value: Column | None, name: str) -> Column:
    return (F.lit(None) if value is None else value).cast("double").alias(name)


def _values(
    table: DataFrame, section: str, item: Column, key: Column, x: Column | None, value: Column
) -> DataFrame:
    return table.select(
        *_place(section, item, key), _number(x, "x"), _number(value, "value"), F.lit(None).cast("string").alias("label")
    )


def consolidate_report(spark: SparkSession, experiment_id: str, paths: ExperimentPaths) -> str:
    """Combine the stored spans and evaluations of an experiment into one stored report table."""
    spans = spark.read.parquet(paths.report(experiment_id, "split_spans"))
    evaluations = {prefix: read_evaluation(spark, paths.report(experiment_id, prefix)) for prefix in SECTIONS}
    return write_metrics(
        report_table(experiment_id, spans, evaluations), paths.report(experiment_id, "combined_report")
    )
