"""Training and scoring as steps that write to the experiment's folders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkexp.config import SCORE_COLUMN, ExperimentPaths
from sparkexp.functions.columns import col
from sparkexp.operators.batches import RESERVED, batch_columns, batch_of, num_batches
from sparkexp.operators.boosting import (
    GAPS,
    ROUNDS_PER_BATCH,
    TrainedModel,
    check_data_arguments,
    load_model,
    train_with,
)
from sparkexp.operators.features import refuse_working_names
from sparkexp.sources.tables import write_predictions


def train_model(
    *,
    experiment_id: str,
    train_data: DataFrame,
    predictors: Sequence[str],
    target_column: str,
    params: Mapping[str, object] | None,
    paths: ExperimentPaths,
    batch_size: int = 1000,
    rounds: int = ROUNDS_PER_BATCH,
    key: Sequence[str] | None = None,
    seed: int = 42,
    trainer: str = "batches",
    batches: int | None = None,
    spread: Sequence[str] | None = None,
    gaps: str = GAPS[0],
) -> str:
    """Train batch by batch, or with ``trainer="one_fit"`` in one fit, and save the model; returns its path."""
    model = train_with(
        trainer,
        train_data,
        predictors=predictors,
        target=target_column,
        params=params,
        batch_size=batch_size,
        rounds=rounds,
        key=key,
        seed=seed,
        batches=batches,
        spread=spread,
        gaps=gaps,
    )
    return model.save(paths.model(experiment_id))


def kept_columns(
    data: DataFrame, target: str, keep: Sequence[str] | None, score_column: str = SCORE_COLUMN
) -> list[str]:
    """The columns to forward: all, or the ones asked for and always the target.

    What an earlier scoring added (score, batch and folder columns) is replaced by the new one's.
    """
    made = (*RESERVED, score_column)
    if keep is None:
        return [name for name in data.columns if name not in made]
    taken = [name for name in keep if name in made]
    if taken:
        raise ValueError(f"Columns {taken} have names the predictions need themselves.")
    absent = [name for name in keep if name not in data.columns]
    if absent:
        raise ValueError(f"Columns {absent} to keep are not in the DataFrame.")
    return list(dict.fromkeys([*keep, target]))


def score_table(
    model: TrainedModel,
    data: DataFrame,
    *,
    target: str,
    batches: int | Column,
    keep_columns: Sequence[str] | None = None,
    key: Sequence[str] | None = None,
    seed: int = 42,
    score_column: str = SCORE_COLUMN,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Add score and batch in one projection over the scan, without moving a row."""
    kept = kept_columns(data, target, keep_columns, score_column)
    refuse_working_names(kept)
    telling = batch_columns(data, key, model.predictors, spread, score_column)
    batched = data.withColumn("batch_id", batch_of(telling, batches, seed))
    scored = model.score(batched, score_column)
    return scored.select(*[col(name) for name in kept], col(score_column), "batch_id")


def predict(
    *,
    experiment_id: str,
    prefix: str,
    model_path: str,
    data: DataFrame,
    predictors: Sequence[str],
    target_column: str,
    paths: ExperimentPaths,
    batch_size: int = 1000,
    keep_columns: Sequence[str] | None = None,
    key: Sequence[str] | None = None,
    seed: int = 42,
    score_column: str = SCORE_COLUMN,
    batch_folders: bool = False,
    spread: Sequence[str] | None = None,
) -> str:
    """Score ``data`` with a saved model and write the result; returns the folder."""
    check_data_arguments(data, predictors, target_column, batch_size)
    kept_columns(data, target_column, keep_columns, score_column)
    model = load_model(data.sparkSession, model_path)
    if tuple(predictors) != model.predictors:
        raise ValueError(f"The model was trained on {list(model.predictors)}, not on {list(predictors)}.")
    batches = max(1, num_batches(data.count(), batch_size))
    scored = score_table(
        model,
        data,
        target=target_column,
        batches=batches,
        keep_columns=keep_columns,
        key=key,
        seed=seed,
        score_column=score_column,
        spread=spread,
    )
    path = paths.predictions(experiment_id, prefix)
    return write_predictions(scored, path, batch_folders=batch_folders)


def predict_splits(
    *,
    experiment_id: str,
    model: TrainedModel,
    data: DataFrame,
    conditions: Mapping[str, Column],
    sizes: Mapping[str, int],
    target_column: str,
    paths: ExperimentPaths,
    batch_size: int = 1000,
    keep_columns: Sequence[str] | None = None,
    key: Sequence[str] | None = None,
    seed: int = 42,
    spread: Sequence[str] | None = None,
) -> dict[str, str]:
    """Score several parts of one table in a single pass; returns the folder of each part.

    ``conditions`` says which rows belong to which part, and ``sizes`` how many there are.
    """
    batches = {name: max(1, num_batches(sizes[name], batch_size)) for name in conditions}
    prefix = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in conditions.items()])
    batches_of_part = F.coalesce(
        *[F.when(conditions[name], F.lit(count).cast("long")) for name, count in batches.items()]
    )
    wanted = list(conditions.values())
    any_part = wanted[0]
    for condition in wanted[1:]:
        any_part = any_part | condition
    rows = data.where(any_part)
    telling = batch_columns(data, key, model.predictors, spread)
    batched = rows.withColumns({"prefix": prefix, "batch_id": batch_of(telling, batches_of_part, seed)})
    kept = kept_columns(data, target_column, keep_columns)
    scored = model.score(batched).select(*[col(name) for name in kept], SCORE_COLUMN, "prefix", "batch_id")
    write_predictions(scored, paths.predictions(experiment_id), by=["prefix"])
    return {name: paths.predictions(experiment_id, name) for name in conditions}
