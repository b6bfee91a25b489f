"""A whole experiment in one call."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame

from sparkexp.config import ColumnRoles, ExperimentPaths, new_run_id
from sparkexp.operators.boosting import GAPS, ROUNDS_PER_BATCH, check_data_arguments, train_with
from sparkexp.operators.batches import num_batches
from sparkexp.operators.split import (
    PreparedExperiment,
    cast_target,
    prepare_experiment,
    scanned,
    split_conditions,
)
from sparkexp.plans.evaluation import Evaluation, consolidate_report, evaluate
from sparkexp.plans.scoring import predict_splits
from sparkexp.plans.together import run_together
from sparkexp.sources.tables import read_predictions, write_metrics


# The parts that are scored and evaluated.
EVALUATED = ("val", "test")


@dataclass(frozen=True)
class ExperimentResult:
    """Where the outcome of a run lies, and its result tables."""

    prepared: PreparedExperiment
    model_path: str
    predictions: dict[str, str]
    evaluations: dict[str, Evaluation]
    report_path: str


def run_experiment(
    data: DataFrame,
    roles: ColumnRoles,
    paths: ExperimentPaths,
    *,
    params: Mapping[str, object],
    start_date: str | date | None = None,
    end_date: str | date | None = None,
    val_size_weeks: int = 4,
    test_size_weeks: int = 4,
    batch_size: int = 1000,
    rounds: int = ROUNDS_PER_BATCH,
    experiment_id: str | None = None,
    cap_test: bool = False,
    seed: int = 42,
    trainer: str = "batches",
    batches: int | None = None,
    gaps: str = GAPS[0],
) -> ExperimentResult:
    """Split, train, score validation and test, evaluate both, and combine the report.

    ``trainer`` is "batches" (``batches`` of them, or by ``batch_size``) or "one_fit"; ``gaps`` says
    how missing values are handled, "direction" or "median".

    Uses the session of ``data`` and neither starts nor stops one. Data moves
    between the steps as tables below ``paths``.
    """
    spark = data.sparkSession
    run_id = experiment_id or new_run_id()
    prepared = prepare_experiment(
        data,
        target_col=roles.target,
        datetime_col=roles.datetime,
        experiment_id=run_id,
        start_date=start_date,
        end_date=end_date,
        val_size_weeks=val_size_weeks,
        test_size_weeks=test_size_weeks,
        cap_test=cap_test,
    )
    write_metrics(prepared.spans, paths.report(run_id, "split_spans"))
    if trainer == "batches" and batches is None:
        check_data_arguments(data, roles.predictors, roles.target, batch_size)
        batches = num_batches(prepared.sizes["train"], batch_size)  # counted already
    model = train_with(
        trainer,
        prepared.train,
        predictors=roles.predictors,
        target=roles.target,
        params=params,
        batch_size=batch_size,
        rounds=rounds,
        key=roles.key or None,
        seed=seed,
        batches=batches,
        spread=roles.spread,
        gaps=gaps,
    )
    conditions = split_conditions(data, roles.datetime, prepared.bounds, cap_test)
    model_path, predictions = run_together(
        lambda: model.save(paths.model(run_id)),
        lambda: predict_splits(
            experiment_id=run_id,
            model=model,
            data=cast_target(scanned(data, roles.datetime, prepared.bounds, EVALUATED, cap_test), roles.target),
            conditions={name: conditions[name] for name in EVALUATED},
            sizes=prepared.sizes,
            target_column=roles.target,
            paths=paths,
            batch_size=batch_size,
            keep_columns=roles.keep,
            key=roles.key or None,
            seed=seed,
            spread=roles.spread,
        ),
    )

    def evaluate_part(prefix: str) -> Evaluation:
        scored = read_predictions(spark, predictions[prefix])
        return evaluate(scored, target_col=roles.target, output=paths.report(run_id, prefix))

    found = run_together(*[partial(evaluate_part, prefix) for prefix in EVALUATED])
    evaluations = dict(zip(EVALUATED, found))
    report_path = consolidate_report(spark, run_id, paths)
    return ExperimentResult(prepared, model_path, predictions, evaluations, report_path)
