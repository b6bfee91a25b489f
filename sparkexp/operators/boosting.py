"""Boosted trees: over all rows at once, or batch by batch.

Trees are grown by Spark aggregations over rows that were binned once (see
:mod:`sparkexp.operators.trees`) and scored by MLlib's tree models on the executors.
"""

from __future__ import annotations

import json
import math
import random
import time
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from sparkexp.config import SCORE_COLUMN, TrainingParams, map_params
from sparkexp.functions.columns import as_boolean, col, key_hash
from sparkexp.operators.batches import batch_columns, batch_of_hash, num_batches
from sparkexp.operators.features import (
    FEATURES,
    PREFIX,
    drop_working_columns,
    finite_double,
    median_stages,
    refuse_working_names,
)
from sparkexp.operators.trees import (
    LABEL,
    MARGIN,
    WEIGHT,
    Sketch,
    Tree,
    TreeGrower,
    add_margins,
    bin_names,
    class_counts,
    distinct_counts,
    ensemble_of,
    sketch_columns,
    with_bins,
)
from sparkexp.sources.publish import publish, published
from sparkexp.sources.scratch import discard, materialize

ROUNDS_PER_BATCH = 10
# After so many trees the margins of the batch are written to the shared folder.
STORE_EVERY = 10
ROWS_OF_FILE, LEAST_ROWS_OF_FILE, FILES_PER_CORE = 2_000_000, 10_000, 3

BATCH, HASH, POSITIVE = "sx_batch", "sx_hash", "sx_positive"
RAW = f"{PREFIX}raw"
# What may become of missing predictor values.
GAPS = ("direction", "median")


def check_training_arguments(
    params: Mapping | None, train: DataFrame, predictors: Sequence[str], target: str, batch_size: int
) -> None:
    """Refuse unusable arguments before any job starts."""
    if params is None:
        raise ValueError("Training needs a parameter dictionary, if only an empty one.")
    check_data_arguments(train, predictors, target, batch_size)


def check_data_arguments(data: DataFrame, predictors: Sequence[str], target: str, batch_size: int) -> None:
    """The checks that training and scoring share."""
    if not isinstance(data, DataFrame):
        raise ValueError(f"The rows come as {type(data).__name__}, not as a Spark DataFrame.")
    if not predictors:
        raise ValueError("No predictor is named.")
    if target not in data.columns:
        raise ValueError(f"The data has no target column '{target}'; it has {data.columns}.")
    absent = [p for p in predictors if p not in data.columns]
    if absent:
        raise ValueError(f"The data lacks the predictors {absent}.")
    refuse_working_names([*predictors, target])
    if batch_size <= 0:
        raise ValueError(f"A batch cannot hold {batch_size} rows.")


class TreeEnsemble:
    """Trees and the values of their leaves. Small: it grows with the trees, not with the rows."""

    def __init__(self, grower: TreeGrower) -> None:
        self.grower = grower
        self.trees: list[Tree] = []
        self.models: list[DecisionTreeRegressionModel] = []
        self.leaf_values: list[list[float]] = []

    def add(self, tree: Tree) -> None:
        self.trees.append(tree)
        self.models.append(self.grower.tree_model(tree))
        self.leaf_values.append(list(tree.values.values()))

    def as_model(self, spark: SparkSession) -> GBTRegressionModel:
        """The trees as one MLlib model over predictor values."""
        return ensemble_of(spark, self.models)


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


@dataclass
class TrainedModel:
    """A fitted model that scores a DataFrame on the executors.

    ``seconds`` has the time that each batch took to train; a loaded model has none.
    """

    pipeline: PipelineModel
    params: TrainingParams
    predictors: tuple[str, ...]
    target: str
    ensemble: GBTRegressionModel
    leaf_values: list[list[float]] = field(default_factory=list)
    seconds: list[float] = field(default_factory=list)

    @property
    def num_trees(self) -> int:
        return self.ensemble.getNumTrees

    def score(self, df: DataFrame, score_column: str = SCORE_COLUMN) -> DataFrame:
        """Add the score; every input column is kept and no row is moved."""
        found = self.ensemble.setPredictionCol(RAW).transform(self.pipeline.transform(df))
        margin = F.col(RAW) + F.lit(_start_margin(self.params))
        value = _probability(margin) if self.params.objective == "logistic" else margin
        return drop_working_columns(found.withColumn(score_column, value))

    def save(self, path: str) -> str:
        """Save under any path Spark can write to, replacing an earlier model."""
        return publish(SparkSession.active(), path, self._write)

    def _write(self, folder: str) -> None:
        self.pipeline.write().save(f"{folder}/pipeline")
        self.ensemble.write().save(f"{folder}/trees")
        settings = {"params": asdict(self.params), "predictors": list(self.predictors), "target": self.target}
        rows = SparkSession.active().createDataFrame([(json.dumps(settings),)], "value string")
        rows.coalesce(1).write.text(f"{folder}/settings")


def save_model(model: TrainedModel, path: str) -> str:
    return model.save(path)


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    """Load a saved model; a path without one raises Spark's own error."""
    folder = published(spark, path)
    settings = json.loads(spark.read.text(f"{folder}/settings").first().value)
    params = TrainingParams(**{**settings["params"], "notes": tuple(settings["params"]["notes"])})
    trees = GBTRegressionModel.load(f"{folder}/trees").setFeaturesCol(FEATURES)
    return TrainedModel(
        PipelineModel.load(f"{folder}/pipeline"), params, tuple(settings["predictors"]), settings["target"], trees
    )


def _start_margin(params: TrainingParams) -> float:
    if params.objective == "logistic":
        return math.log(params.base_score / (1 - params.base_score))
    return params.base_score


def _check_label(sketch: Sketch, target: str) -> None:
    if sketch.rows == 0:
        raise ValueError("There are no rows to train on.")
    if sketch.positives + sketch.negatives < sketch.rows:
        raise ValueError(f"Target column '{target}' holds nulls.")
    if not sketch.positives or not sketch.negatives:
        warnings.warn("All training rows are of one class.", stacklevel=3)


def _vector_stages(values: Sequence[str]) -> list:
    """The steps from SQL texts of finite doubles (null where missing) to the vector that the trees decide on:
    each value with gaps beyond every cut, then each with gaps below every cut."""
    made = [f"coalesce({v}, CAST('Infinity' AS DOUBLE)) AS {PREFIX}a{i}" for i, v in enumerate(values)]
    made += [f"coalesce({v}, CAST('-Infinity' AS DOUBLE)) AS {PREFIX}z{i}" for i, v in enumerate(values)]
    names = [f"{PREFIX}{side}{i}" for side in "az" for i in range(len(values))]
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol=FEATURES, handleInvalid="keep"),
    ]


def train_gbt(
    train: DataFrame,
    *,
    predictors: Sequence[str],
    target: str,
    params: Mapping[str, object],
    max_iter: int = ROUNDS_PER_BATCH,
    seed: int = 42,
    key: Sequence[str] | None = None,
    spread: Sequence[str] | None = None,
    gaps: str = GAPS[0],
) -> TrainedModel:
    """Boost ``max_iter`` trees over all rows at once."""
    return train_gbt_incremental(
        train,
        predictors=predictors,
        target=target,
        params=params,
        rounds=max_iter,
        key=key,
        seed=seed,
        batches=1,
        spread=spread,
        gaps=gaps,
    )


def train_gbt_incremental(
    train: DataFrame,
    *,
    predictors: Sequence[str],
    target: str,
    params: Mapping[str, object],
    batch_size: int = 1000,
    rounds: int = ROUNDS_PER_BATCH,
    key: Sequence[str] | None = None,
    seed: int = 42,
    batches: int | None = None,
    spread: Sequence[str] | None = None,
    gaps: str = GAPS[0],
    store_every: int = STORE_EVERY,
) -> TrainedModel:
    """Train ``rounds`` trees on each batch in turn, each batch continuing from the trees before it.

    There are ``batches`` batches, or as many as rows of about ``batch_size`` need. A row's batch
    follows from ``key`` and ``spread`` as in scoring (see ``batch_columns``). The input is read once:
    hash, label and predictor values are stored and counted on the way. From there the columns are
    sketched and their bins written to the shared folder, one folder per batch,
    so that a batch later reads its own rows and no others. The margins of a
    batch are written there too, at its start and after every ``store_every`` trees; each tree starts from
    that table, so what a lost executor costs does not grow with the trees.

    With ``gaps="direction"`` each split learns the side of missing values; values that are missing where
    training had none go right. With "median" they become the training median first, beside a column
    that says where they were.
    """
    check_training_arguments(params, train, predictors, target, batch_size)
    if gaps not in GAPS:
        raise ValueError(f"Missing values are handled by one of {list(GAPS)}, not by '{gaps}'.")
    settings = map_params(params)
    spark = train.sparkSession
    telling = batch_columns(train, key, predictors, spread)
    roles = train.select(*[col(name) for name in dict.fromkeys([*telling, *predictors, target])])
    positive = as_boolean(col(target))
    first_steps, values = median_stages(roles, predictors) if gaps == "median" else ([], [finite_double(p) for p in predictors])
    prepared = PipelineModel(first_steps).transform(roles)
    # What the input is read for: it may be dear to compute, and the steps after need it three times.
    wide = prepared.select(
        key_hash(telling, seed).alias(HASH), positive.alias(POSITIVE), *[F.expr(v).alias(f"value{i}") for i, v in enumerate(values)]
    )
    columns = [F.col(f"value{i}") for i in range(len(values))]
    counted = Observation()
    raw, raw_path = materialize(wide.observe(counted, *class_counts(F.col(POSITIVE)), *distinct_counts(columns)), "values")
    try:
        sketch = sketch_columns(raw, columns, F.col(POSITIVE), settings.max_bin, counted.get)
        _check_label(sketch, target)
        if batches is None:
            batches = num_batches(sketch.rows, batch_size)
        batches = max(1, batches)
        kept = [HASH, POSITIVE, *bin_names(len(columns))]
        rows = with_bins(raw, columns, sketch).select(*kept, batch_of_hash(F.col(HASH), batches).alias(BATCH))
        files = files_of_batch(sketch.rows // batches, spark.sparkContext.defaultParallelism)
        # The batch is a remainder of the hash, so its parts are taken from another one.
        part = F.pmod(F.xxhash64(HASH), F.lit(files))
        staged, path = materialize(rows.repartition(files * batches, BATCH, part), "training", partition_by=BATCH)
    finally:
        discard(spark, raw_path)
    model, seconds = TreeEnsemble(TreeGrower(spark, sketch, settings)), []
    try:
        weight = F.when(F.col(POSITIVE), F.lit(settings.scale_pos_weight)).otherwise(F.lit(1.0))
        labelled = staged.withColumns({LABEL: F.col(POSITIVE).cast("double"), WEIGHT: weight})
        for batch in range(batches):
            started = time.monotonic()
            _train_stage(labelled.where(F.col(BATCH) == batch).drop(BATCH), model, settings, rounds, seed + batch * rounds, store_every)
            seconds.append(time.monotonic() - started)
    finally:
        discard(spark, path)
    if not model.trees:
        raise ValueError("No tree was trained: 'subsample' drew no row of any batch.")
    pipeline = PipelineModel([*first_steps, *_vector_stages(values)])
    return TrainedModel(
        pipeline, settings, tuple(predictors), target, model.as_model(spark), model.leaf_values, seconds
    )


def files_of_batch(rows: int, cores: int) -> int:
    """Into how many files a batch is dealt: some for each core, but neither tiny nor huge ones."""
    return max(1, -(-rows // ROWS_OF_FILE), min(FILES_PER_CORE * cores, rows // LEAST_ROWS_OF_FILE))


# The names of the two trainers.
TRAINERS = ("batches", "one_fit")


def train_with(
    trainer: str,
    train: DataFrame,
    *,
    predictors: Sequence[str],
    target: str,
    params: Mapping[str, object],
    batch_size: int,
    rounds: int,
    key: Sequence[str] | None,
    seed: int,
    batches: int | None,
    spread: Sequence[str] | None = None,
    gaps: str = GAPS[0],
) -> TrainedModel:
    """Train batch by batch, or in one fit of ``rounds`` trees over all rows; the caller says which."""
    if trainer not in TRAINERS:
        raise ValueError(f"There is no trainer '{trainer}'; there are {list(TRAINERS)}.")
    return train_gbt_incremental(
        train,
        predictors=predictors,
        target=target,
        params=params,
        batch_size=batch_size,
        rounds=rounds,
        key=key,
        seed=seed,
        batches=1 if trainer == "one_fit" else batches,
        spread=spread,
        gaps=gaps,
    )


def _train_stage(
    stage: DataFrame, model: TreeEnsemble, params: TrainingParams, rounds: int, seed: int, store_every: int = STORE_EVERY
) -> None:
    """Add up to ``rounds`` trees grown on one batch.

    A pass over the rows adds the values of the trees since the margins were last
    written, fewer than ``store_every``, so trees late in a batch cost what early ones do.
    """
    spark, count = stage.sparkSession, len(model.grower.cuts)
    base, written, stored = stage.withColumn(MARGIN, F.lit(_start_margin(params))), None, 0
    try:
        for number in range(rounds):
            pending = model.trees[stored:]
            if len(pending) >= store_every or (number == 0 and pending):
                base, fresh = materialize(add_margins(base, pending, count), "margins")
                stored, pending = len(model.trees), []
                if written:
                    discard(spark, written)
                written = fresh
            drawn = base.where(_is_drawn(params.subsample, seed + number)) if params.subsample < 1.0 else base
            chosen = drawn_columns(count, params.colsample, seed + number) if params.colsample < 1.0 else range(count)
            tree = model.grower.grow(drawn, chosen, pending)
            if tree is not None:
                model.add(tree)
    finally:
        if written:
            discard(spark, written)


def _is_drawn(share: float, seed: int) -> Column:
    """Whether a row is in this tree's random part. It depends on the row's key alone, so that
    every pass over the rows sees the same part, also after an executor is lost."""
    million = 1_000_000
    return F.pmod(F.xxhash64(HASH, F.lit(str(seed))), F.lit(million)) < share * million


def drawn_columns(size: int, share: float, seed: int) -> list[int]:
    """The columns of one tree: a share of all, rounded down, and one at least."""
    return sorted(random.Random(seed).sample(range(size), max(1, int(share * size))))
