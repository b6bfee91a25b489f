"""Settings passed between the steps of an experiment."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

SCORE_COLUMN = "final_score"


@dataclass(frozen=True)
class ColumnRoles:
    """Which columns of the labelled table play which part.

    ``key`` names the columns that tell rows apart; it decides the batch of a
    row, together with ``spread`` (the predictors when left out). ``keep`` lists the columns to forward to the predictions (all when
    left out).
    """

    target: str
    datetime: str
    predictors: tuple[str, ...]
    key: tuple[str, ...] = ()
    keep: tuple[str, ...] | None = None
    spread: tuple[str, ...] | None = None


@dataclass(frozen=True)
class ExperimentPaths:
    """Where an experiment keeps its tables. ``root`` is any path Spark can write to."""

    root: str

    def _below(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # The folder names below the root.
    def dataset(self, run_id: str) -> str:
        return self._below("data", "random_data", run_id)

    @property
    def predictions_root(self) -> str:
        return self._below("data", "batch_predictions")

    def predictions(self, experiment_id: str, prefix: str | None = None) -> str:
        parts = [f"experiment_id={experiment_id}"] + ([f"prefix={prefix}"] if prefix else [])
        return "/".join([self.predictions_root, *parts])

    def report(self, experiment_id: str, *parts: str) -> str:
        return self._below("reports", experiment_id, *parts)

    def model(self, experiment_id: str) -> str:
        return self._below("models", experiment_id, "gbt_trained.model")


def new_run_id() -> str:
    """An id from the clock, such as ``20230131235959``."""
    return datetime.now().strftime("%Y%m%d%H%M%S")


# Booster parameter names, their aliases, and their documented defaults.
PARAMETER_ALIASES = {
    "learning_rate": "eta",
    "reg_lambda": "lambda",
    "reg_alpha": "alpha",
    "min_split_loss": "gamma",
}
PARAMETER_DEFAULTS = {
    "objective": "reg:squarederror",
    "base_score": 0.5,
    "max_depth": 6,
    "eta": 0.3,
    "subsample": 1.0,
    "colsample_bytree": 1.0,
    "max_bin": 256,
    "lambda": 1.0,
    "alpha": 0.0,
    "gamma": 0.0,
    "min_child_weight": 1.0,
    "scale_pos_weight": 1.0,
}
# Accepted and without effect: the cluster decides parallelism, trees are always
# grown on histograms, and the evaluation step always reports log loss, AUC and
# average precision.
PARAMETERS_WITHOUT_EFFECT = ("nthread", "n_jobs", "tree_method", "eval_metric", "verbosity", "seed")
OBJECTIVES = {
    "reg:squarederror": "squared",
    "squared": "squared",
    "binary:logistic": "logistic",
    "logistic": "logistic",
}


@dataclass(frozen=True)
class TrainingParams:
    """Boosting parameters in the form the trainers use."""

    objective: str = "squared"
    base_score: float = 0.5
    max_depth: int = 6
    eta: float = 0.3
    subsample: float = 1.0
    colsample: float = 1.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    scale_pos_weight: float = 1.0
    max_bin: int = 256
    notes: tuple[str, ...] = field(default=(), compare=False)


def map_params(params: Mapping[str, object]) -> TrainingParams:
    """Translate a booster parameter dictionary; what cannot be honoured is noted and warned about."""
    values, notes = dict(PARAMETER_DEFAULTS), []
    for name, value in params.items():
        name = PARAMETER_ALIASES.get(name, name)
        if name in values:
            values[name] = value
        elif name in PARAMETERS_WITHOUT_EFFECT:
            notes.append(f"'{name}' has no effect here")
        else:
            notes.append(f"'{name}' is unknown and ignored")
            warnings.warn(notes[-1], stacklevel=2)
    if values["objective"] not in OBJECTIVES:
        raise ValueError(f"Objective '{values['objective']}' is not one of {sorted(OBJECTIVES)}.")
    return TrainingParams(
        objective=OBJECTIVES[values["objective"]],
        base_score=float(values["base_score"]),
        max_depth=int(values["max_depth"]),
        eta=float(values["eta"]),
        subsample=float(values["subsample"]),
        colsample=float(values["colsample_bytree"]),
        reg_lambda=float(values["lambda"]),
        reg_alpha=float(values["alpha"]),
        gamma=float(values["gamma"]),
        min_child_weight=float(values["min_child_weight"]),
        scale_pos_weight=float(values["scale_pos_weight"]),
        max_bin=int(values["max_bin"]),
        notes=tuple(notes),
    )
