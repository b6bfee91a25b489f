from __future__ import annotations

import math
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkexp.config import ExperimentPaths, map_params
from sparkexp.functions.columns import key_hash
from sparkexp.operators import boosting
from sparkexp.operators.boosting import load_model, save_model, train_gbt, train_gbt_incremental
from sparkexp.operators.features import impute_missing
from sparkexp.operators.metrics import roc_auc
from sparkexp.operators.trees import LABEL, MARGIN, WEIGHT, TreeGrower, sketch_columns, with_bins
from sparkexp.plans.scoring import predict, score_table, train_model
from sparkexp.sources.tables import read_predictions

# The small table of the workload.
SMALL = [
    ("id1", 1, 0.1, False),
    ("id2", 2, 0.2, False),
    ("id3", 3, 0.3, False),
    ("id4", 4, 0.4, True),
    ("id5", 5, 0.5, False),
]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(SMALL, "id string, feature1 long, feature2 double, target boolean")


@pytest.fixture(scope="module")
def separable(spark):
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    return lineitem.select(
        F.monotonically_increasing_id().alias("id"),
        "l_quantity",
        "l_discount",
        "l_tax",
        (F.col("l_quantity") * F.col("l_discount") > 1).alias("target"),
    ).cache()


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"params": None, "train_data": None}, "parameter dictionary"),
        ({"train_data": None, "predictors": []}, "not as a Spark DataFrame"),
        ({"predictors": [], "target_column": "label"}, "No predictor"),
        ({"target_column": "label", "batch_size": 0}, "no target column 'label'"),
        ({"predictors": ["feature1", "feature9"]}, "feature9"),
        ({"batch_size": -1}, "cannot hold -1 rows"),
    ],
)
def test_training_arguments_are_checked_in_order(small, tmp_path, change, message):
    arguments = {
        "experiment_id": "exp1",
        "train_data": small,
        "predictors": ["feature1", "feature2"],
        "target_column": "target",
        "params": {"max_depth": 3},
        "paths": ExperimentPaths(str(tmp_path)),
        "batch_size": 2,
    }
    with pytest.raises(ValueError, match=message):
        train_model(**{**arguments, **change})


def test_small_model_from_training_to_scored_table(spark, small, tmp_path):
    paths = ExperimentPaths(str(tmp_path))
    model_path = train_model(
        experiment_id="exp1",
        train_data=small,
        predictors=["feature1", "feature2"],
        target_column="target",
        params={"max_depth": 3},
        paths=paths,
        batch_size=2,
        rounds=2,
        key=["id"],
    )
    assert model_path == paths.model("exp1")
    rows = [(f"id{i}", 100, "2022-10-10", i, i / 10, i % 2) for i in range(1, 6)]
    data = spark.createDataFrame(
        rows, "id string, someValue long, datetimeCol string, feature1 long, feature2 double, target long"
    )
    arguments = {
        "experiment_id": "exp1",
        "prefix": "val",
        "model_path": model_path,
        "data": data,
        "predictors": ["feature1", "feature2"],
        "target_column": "target",
        "paths": paths,
        "batch_size": 2,
        "key": ["id"],
    }
    everything = read_predictions(spark, predict(**arguments))
    assert sorted(everything.columns) == sorted([*data.columns, "final_score", "batch_id"])
    assert everything.count() == 5 and everything.where("final_score IS NULL").count() == 0
    kept = predict(**{**arguments, "keep_columns": ["id", "someValue"], "score_column": "xgb.final_score"})
    assert set(read_predictions(spark, kept).columns) == {"id", "someValue", "target", "xgb.final_score", "batch_id"}

    for change in (
        {"data": None},
        {"target_column": "label"},
        {"predictors": []},
        {"predictors": ["feature2", "feature1"]},
        {"batch_size": 0},
        {"keep_columns": ["nothing"]},
    ):
        with pytest.raises(ValueError):
            predict(**{**arguments, **change})
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        predict(**{**arguments, "model_path": str(tmp_path / "nowhere")})


def squared_error(df):
    return df.agg(F.avg((F.col("target").cast("double") - F.col("final_score")) ** 2)).first()[0]


def test_error_falls_from_batch_to_batch(separable):
    errors = []
    for rounds in (1, 2, 4):
        model = train_gbt_incremental(
            separable,
            predictors=["l_quantity", "l_discount", "l_tax"],
            target="target",
            params={"max_depth": 3, "eta": 0.5},
            batch_size=3001,
            rounds=rounds,
            key=["id"],
        )
        assert model.num_trees == 2 * rounds
        errors.append(squared_error(model.score(separable)))
    assert 0.25 > errors[0] > errors[1] > errors[2]


@pytest.mark.parametrize("objective", ["reg:squarederror", "binary:logistic"])
@pytest.mark.parametrize("trainer", ["batches", "whole"])
def test_score_survives_saving(spark, separable, tmp_path, objective, trainer):
    options = {
        "predictors": ["l_quantity", "l_discount"],
        "target": "target",
        "params": {"max_depth": 3, "eta": 0.5, "subsample": 0.8, "lambda": 0, "objective": objective},
    }
    if trainer == "batches":
        model = train_gbt_incremental(separable, batch_size=4000, rounds=3, key=["id"], **options)
    else:
        model = train_gbt(separable, max_iter=4, **options)
    scored = model.score(separable)
    assert scored.columns == [*separable.columns, "final_score"]
    assert roc_auc(scored, "target").first().auc > 0.95
    loaded = load_model(spark, save_model(model, str(tmp_path / "model")))
    assert loaded.num_trees == model.num_trees
    both = scored.join(loaded.score(separable).select("id", F.col("final_score").alias("again")), "id")
    assert both.where("NOT final_score <=> again").count() == 0
    if objective == "binary:logistic":
        assert scored.where("final_score NOT BETWEEN 0 AND 1").count() == 0


@pytest.mark.parametrize(("penalty", "absolute"), [(0.0, 0.0), (2.0, 0.0), (1.0, 1.5)])
def test_leaf_values_follow_the_penalised_formula(spark, penalty, absolute):
    """One split on one feature: each leaf adds eta * shrunk sum of residuals / (rows + lambda)."""
    rows = [(i, 0.0, i < 2) for i in range(10)] + [(i, 1.0, i < 18) for i in range(10, 20)]
    df = spark.createDataFrame(rows, "id long, x double, y boolean")
    params = {"max_depth": 1, "eta": 0.1, "lambda": penalty, "alpha": absolute, "base_score": 0.5}
    model = train_gbt_incremental(df, predictors=["x"], target="y", params=params, batch_size=100, rounds=1, key=["id"])
    got = {r.x: r.final_score for r in model.score(df).select("x", "final_score").distinct().collect()}
    for x, residual in ((0.0, -3.0), (1.0, 3.0)):
        shrunk = math.copysign(abs(residual) - absolute, residual)
        assert got[x] == pytest.approx(0.5 + 0.1 * shrunk / (10 + penalty), abs=1e-12)


def test_logistic_leaf_values(spark):
    rows = [(i, 0.0, i < 2) for i in range(10)] + [(i, 1.0, i < 18) for i in range(10, 20)]
    df = spark.createDataFrame(rows, "id long, x double, y boolean")
    params = {"max_depth": 1, "eta": 0.3, "lambda": 1, "objective": "binary:logistic", "scale_pos_weight": 2}
    model = train_gbt_incremental(df, predictors=["x"], target="y", params=params, batch_size=100, rounds=1, key=["id"])
    got = {r.x: r.final_score for r in model.score(df).select("x", "final_score").distinct().collect()}
    for x, positives in ((0.0, 2), (1.0, 8)):
        negatives = 10 - positives
        margin = 0.3 * (2 * positives * 0.5 - negatives * 0.5) / (0.25 * (2 * positives + negatives) + 1)
        assert got[x] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-12)


def test_every_row_is_trained_on_once(spark, separable, monkeypatch):
    seen = []

    def record(stage, model, *rest):
        seen.extend(row[0] for row in stage.select("_sx_weight").collect())
        model.trees.append(None)

    monkeypatch.setattr(boosting, "_train_stage", record)
    monkeypatch.setattr(boosting.TreeEnsemble, "as_model", lambda self, spark: None)
    train_gbt_incremental(
        separable,
        predictors=["l_quantity"],
        target="target",
        params={"scale_pos_weight": 3},
        batch_size=1000,
        key=["id"],
    )
    positives = separable.where("target").count()
    assert len(seen) == separable.count()
    assert sum(seen) == separable.count() + 2 * positives


def test_missing_values_and_a_predictor_without_values(spark):
    df = spark.range(400).select(
        "id",
        F.when(F.col("id") % 2 == 0, F.lit(1.0)).when(F.col("id") % 4 == 1, F.lit(float("nan"))).alias("x"),
        F.lit(None).cast("double").alias("nothing"),
        (F.col("id") % 2 == 1).alias("y"),
    )
    model = train_gbt_incremental(
        df, predictors=["x", "nothing"], target="y", params={"max_depth": 2}, batch_size=400, rounds=2, key=["id"]
    )
    scored = model.score(df)
    assert roc_auc(scored, "y").first().auc == 1.0
    assert scored.where("final_score IS NULL").count() == 0


def test_impute_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,), (None,), (float("nan"),)], "v double")
    rows = impute_missing(df, ["v"]).collect()
    assert [(r.v_missing, r.v_filled) for r in rows] == [(0, 1.0), (0, 3.0), (0, 5.0), (1, 3.0), (1, 3.0)]
    with pytest.raises(ValueError, match="median of in: w"):
        impute_missing(df.withColumn("w", F.lit(None).cast("double")), ["v", "w"])


def test_training_data_that_cannot_be_used(spark, small):
    options = {"predictors": ["feature1"], "target": "target", "params": {}}
    with pytest.raises(ValueError, match="no rows"):
        train_gbt_incremental(small.limit(0), **options)
    with pytest.raises(ValueError, match="holds nulls"):
        train_gbt_incremental(small.withColumn("target", F.lit(None).cast("boolean")), **options)
    with pytest.warns(UserWarning, match="one class"):
        train_gbt_incremental(small.where("NOT target"), batch_size=10, rounds=1, key=["id"], **options)


def test_training_is_repeatable_however_the_rows_are_laid_out(separable):
    scores = []
    for rows in (separable.repartition(5), separable.coalesce(1)):
        model = train_gbt_incremental(
            rows,
            predictors=["l_quantity", "l_discount"],
            target="target",
            params={"max_depth": 2, "eta": 0.5, "subsample": 0.5},
            batch_size=3001,
            rounds=2,
            key=["id"],
        )
        scores.append(sorted((r.id, round(r.final_score, 9)) for r in model.score(separable).collect()))
    assert scores[0] == scores[1]


def test_a_part_without_rows_trains_no_tree(small):
    with pytest.raises(ValueError, match="No tree was trained"):
        train_gbt_incremental(
            small, predictors=["feature1"], target="target", params={"subsample": 1e-9}, batch_size=5, rounds=1, key=["id"]
        )


def test_many_small_batches_are_trained(small):
    """As many batches as rows, with some of them empty, and one tree object list for all."""
    model = train_gbt_incremental(
        small, predictors=["feature1"], target="target", params={"min_child_weight": 0}, batch_size=1, rounds=3, key=["id"]
    )
    assert 3 <= model.num_trees == len(model.leaf_values) <= 15
    given = train_gbt_incremental(small, predictors=["feature1"], target="target", params={}, batches=2, rounds=1, key=["id"])
    assert given.num_trees <= 2


def test_columns_are_drawn_once_for_each_tree(separable):
    for seed in range(5):
        assert len(boosting.drawn_columns(2, 0.8, seed)) == 1
        assert len(boosting.drawn_columns(10, 0.8, seed)) == 8
    model = train_gbt_incremental(
        separable,
        predictors=["l_quantity", "l_discount"],
        target="target",
        params={"max_depth": 3, "colsample_bytree": 0.8},
        batches=1,
        rounds=6,
        key=["id"],
    )
    used = [set(re.findall(r"feature (\d+)", tree.toDebugString)) for tree in model.ensemble.trees]
    assert all(len(features) == 1 for features in used) and set.union(*used) == {"0", "1"}


def one_split(spark, **params):
    rows = [(i, 0.0, i < 2) for i in range(10)] + [(i, 1.0, i < 18) for i in range(10, 20)]
    df = spark.createDataFrame(rows, "id long, x double, y boolean")
    model = train_gbt_incremental(
        df, predictors=["x"], target="y", params={"max_depth": 1, "eta": 1, "lambda": 0, **params}, batches=1, rounds=1, key=["id"]
    )
    return len(set(model.leaf_values[0]))


def test_gamma_is_a_loss_and_child_weight_a_curvature(spark):
    # The split lowers the squared loss by (9/10 + 9/10) / 2 = 0.9.
    assert one_split(spark, gamma=0.89) == 2 and one_split(spark, gamma=0.91) == 1
    # Ten rows a side; logistic curvature is a quarter of a row each.
    assert one_split(spark, min_child_weight=9.9) == 2 and one_split(spark, min_child_weight=10.1) == 1
    logistic = {"objective": "binary:logistic"}
    assert one_split(spark, min_child_weight=2.4, **logistic) == 2
    assert one_split(spark, min_child_weight=2.6, **logistic) == 1
    # Logistic: (9/2.5 + 9/2.5) / 2 = 3.6.
    assert one_split(spark, gamma=3.59, **logistic) == 2 and one_split(spark, gamma=3.61, **logistic) == 1


def test_gamma_prunes_from_the_leaves_up(separable):
    options = {"predictors": ["l_quantity", "l_discount"], "target": "target", "batches": 1, "rounds": 1, "key": ["id"]}
    values = [
        len(set(train_gbt_incremental(separable, params={"max_depth": 4, "gamma": g}, **options).leaf_values[0])) for g in (0, 20, 10**6)
    ]
    assert values[0] > values[1] > values[2] == 1


# The workload's own parameters.
WORKLOAD = {
    "max_depth": 1,
    "eta": 0.1,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "lambda": 1,
    "alpha": 0,
    "gamma": 0,
    "min_child_weight": 1,
    "objective": "reg:squarederror",
    "eval_metric": "logloss",
    "nthread": 3,
}


def test_one_fit_takes_every_parameter(separable):
    options = {"predictors": ["l_quantity", "l_discount"], "target": "target", "key": ["id"]}
    model = train_gbt(separable, params=WORKLOAD, max_iter=3, **options)
    assert model.num_trees == 3 and len(model.seconds) == 1 and model.seconds[0] > 0
    plain, shrunk, pruned = (
        train_gbt(separable, params={"max_depth": 2, "lambda": 0, "eta": 1, **p}, max_iter=1, **options).leaf_values[0]
        for p in ({}, {"lambda": 1e6, "alpha": 1}, {"gamma": 1e6})
    )
    assert max(map(abs, shrunk)) < 0.01 * max(map(abs, plain)) and len(plain) == 4 and len(pruned) == 1


def test_trainers_by_name(small, tmp_path):
    arguments = {
        "train_data": small,
        "predictors": ["feature1"],
        "target_column": "target",
        "params": {"max_depth": 2},
        "paths": ExperimentPaths(str(tmp_path)),
        "rounds": 2,
    }
    loaded = [
        load_model(small.sparkSession, train_model(experiment_id=name, trainer=name, batches=1, **arguments))
        for name in ("one_fit", "batches")
    ]
    assert [m.num_trees for m in loaded] == [2, 2]
    assert len({tuple(r.final_score for r in m.score(small).orderBy("id").collect()) for m in loaded}) == 1
    with pytest.raises(ValueError, match="no trainer"):
        train_model(experiment_id="x", trainer="other", **arguments)


def test_predictions_can_be_scored_again(spark, small, tmp_path):
    paths = ExperimentPaths(str(tmp_path))
    model_path = train_model(
        experiment_id="e", train_data=small, predictors=["feature1"], target_column="target", params={}, paths=paths, batches=1, rounds=1
    )
    arguments = {"experiment_id": "e", "model_path": model_path, "predictors": ["feature1"], "target_column": "target", "paths": paths}
    first = read_predictions(spark, predict(prefix="val", data=small, **arguments))
    again = read_predictions(spark, predict(prefix="test", data=first, **arguments))
    assert again.columns == first.columns
    assert sorted(again.collect()) == sorted(first.collect())


def test_working_names_are_refused(small):
    with pytest.raises(ValueError, match="_sx_own"):
        train_gbt_incremental(small.withColumn("_sx_own", F.lit(1)), predictors=["_sx_own"], target="target", params={})


def test_nothing_is_left_in_the_shared_folder(spark, separable, tmp_path):
    from sparkexp.operators.batches import assign_batches, batch_ledger
    from sparkexp.plans.evaluation import evaluate
    from sparkexp.sources.scratch import scratch_root

    def files():
        return {str(p) for p in Path(scratch_root(spark).removeprefix("file:")).rglob("*.parquet")}

    before = files()
    model = train_gbt_incremental(separable, predictors=["l_quantity"], target="target", params={"subsample": 0.5}, batches=2, rounds=2, key=["id"])
    scored = model.score(separable).withColumn("final_score", F.col("final_score"))
    batch_ledger(assign_batches(scored, "id", 100), "target").collect()
    evaluate(scored, target_col="target", output=str(tmp_path / "out"))
    kept = evaluate(scored, target_col="target")
    kept.metrics.collect()
    kept.close()
    with pytest.raises(ValueError):
        evaluate(scored.withColumn("target", F.lit(None).cast("boolean")), target_col="target")
    assert files() == before


def brute_force_stump(rows, penalty, least=1.0):
    """Try every split of every column with the gaps on both sides; rows are (values, residual)."""
    def score(part):
        return sum(r for _, r in part) ** 2 / (len(part) + penalty) if part else 0.0

    best = None
    for column in range(len(rows[0][0])):
        known = [r for r in rows if r[0][column] is not None]
        gaps = [r for r in rows if r[0][column] is None]
        for cut in sorted({r[0][column] for r in known}):
            low = [r for r in known if r[0][column] <= cut]
            high = [r for r in known if r[0][column] > cut]
            for right in (True, False):
                left, rest = (low, high + gaps) if right else (low + gaps, high)
                if len(left) < least or len(rest) < least:
                    continue
                gain = 0.5 * (score(left) + score(rest) - score(rows))
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, column, cut, right, left, rest)
    return best


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("penalty", [0, 5])
def test_stumps_with_gaps_agree_with_trying_every_split(spark, seed, penalty):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        x = [rng.choice([None, float("nan"), *range(6)]) if rng.random() < 0.9 else None for _ in range(3)]
        rows.append((i, *[None if v is None else float(v) for v in x], rng.random() < (0.8 if x[seed % 3] is None else 0.3)))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y boolean")
    params = {"max_depth": 1, "eta": 1, "lambda": penalty, "base_score": 0.5}
    model = train_gbt_incremental(df, predictors=["a", "b", "c"], target="y", params=params, batches=1, rounds=1, key=["id"])
    clean = [([None if v is None or math.isnan(v) else v for v in r[1:4]], float(r[4]) - 0.5) for r in rows]
    _, column, cut, right, left, rest = brute_force_stump(clean, penalty)
    values = [sum(r for _, r in side) / (len(side) + penalty) for side in (left, rest)]
    got = {r.id: r.final_score for r in model.score(df).collect()}
    for (x, _), row in zip(clean, rows):
        goes_right = right if x[column] is None else x[column] > cut
        assert got[row[0]] == pytest.approx(0.5 + values[goes_right], abs=1e-9)


def test_gaps_go_where_the_loss_is_least_and_median_stays_an_option(spark, tmp_path):
    """Gaps behave like the low values, so sending them right or filling in the median would be worse."""
    rows = [(i, None if i % 3 == 0 else float(i % 10), i % 3 == 0 or i % 10 < 3) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, x double, y boolean")
    options = {"predictors": ["x"], "target": "y", "params": {"max_depth": 1, "eta": 1, "lambda": 0}, "rounds": 1, "batches": 1, "key": ["id"]}
    learned = train_gbt_incremental(df, **options)
    assert squared_error(learned.score(df).withColumnRenamed("y", "target")) == pytest.approx(0, abs=1e-12)
    loaded = load_model(spark, save_model(learned, str(tmp_path / "m")))
    assert squared_error(loaded.score(df).withColumnRenamed("y", "target")) == pytest.approx(0, abs=1e-12)
    median = train_gbt_incremental(df, gaps="median", **options)
    scored = median.score(df)
    assert set(scored.columns) == {*df.columns, "final_score"} and squared_error(scored.withColumnRenamed("y", "target")) > 0.01
    with pytest.raises(ValueError, match="direction"):
        train_gbt_incremental(df, gaps="other", **options)


def test_gaps_that_training_did_not_have_go_right(spark):
    df = spark.createDataFrame([(i, float(i % 2), i % 2 == 1) for i in range(20)], "id long, x double, y boolean")
    model = train_gbt_incremental(df, predictors=["x"], target="y", params={"eta": 1, "lambda": 0}, batches=1, rounds=1, key=["id"])
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),), (0.5,)], "x double")
    assert [r.final_score for r in model.score(odd).collect()] == pytest.approx([1, 1, 1, 0, 0])


def test_infinite_values_are_the_largest_finite_ones(spark):
    rows = [(i, (float("-inf"), 0.0, float("inf"))[i % 3], i % 3 == 2) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, x double, y boolean")
    model = train_gbt_incremental(df, predictors=["x"], target="y", params={"eta": 1, "lambda": 0, "max_depth": 2}, batches=1, rounds=1, key=["id"])
    assert squared_error(model.score(df).withColumnRenamed("y", "target")) == pytest.approx(0, abs=1e-12)


def test_lambda_takes_part_in_the_choice_of_the_split(spark):
    """A few clean rows on one column win without a penalty, many less clean ones on the other with it."""
    rows = [(i, float(i < 4), float(i % 2), i < 4 or (i % 2 == 1 and i % 10 != 9) or i % 10 == 8) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y boolean")
    used = []
    for penalty in (0, 50):
        params = {"max_depth": 1, "lambda": penalty, "base_score": 0.45}
        model = train_gbt_incremental(df, predictors=["a", "b"], target="y", params=params, batches=1, rounds=1, key=["id"])
        residuals = [([r[1], r[2]], float(r[3]) - 0.45) for r in rows]
        assert model.ensemble.trees[0]._java_obj.rootNode().split().featureIndex() == brute_force_stump(residuals, penalty)[1]
        used.append(brute_force_stump(residuals, penalty)[1])
    assert used[1] == 1


def deep_tree(spark, separable, cells):
    summed = sketch_columns(separable, [F.col(c) for c in ("l_quantity", "l_discount", "l_tax")], F.col("target"), 16)
    rows = with_bins(separable, [F.col(c) for c in ("l_quantity", "l_discount", "l_tax")], summed).withColumns(
        {LABEL: F.col("target").cast("double"), WEIGHT: F.lit(1.0), MARGIN: F.lit(0.5)}
    )
    grower = TreeGrower(spark, summed, map_params({"max_depth": 5, "lambda": 1}), cells)
    tree = grower.grow(rows, range(3))
    return [(n.column, n.bin, n.rows, n.left, round(n.gain, 6)) for n in tree.nodes]


def test_blocks_of_columns_and_subtraction_grow_the_same_tree(spark, separable):
    whole = deep_tree(spark, separable, 1_000_000)
    assert len(whole) > 20
    assert deep_tree(spark, separable, 40) == whole  # a block is one column, and no sums are kept


def test_every_tree_fits_the_rows_as_binned_before(spark, separable):
    """Stored margins, pending trees and the final model agree."""
    options = {"predictors": ["l_quantity", "l_discount"], "target": "target", "params": {"max_depth": 2, "eta": 0.3}, "rounds": 5, "batches": 2, "key": ["id"]}
    scores = []
    for every in (1, 2, 100):
        model = train_gbt_incremental(separable, store_every=every, **options)
        scores.append(sorted((r.id, round(r.final_score, 9)) for r in model.score(separable).collect()))
    assert scores[0] == scores[1] == scores[2]


def test_many_distinct_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).select("id", (F.col("id") * 1.0).alias("x"), (F.col("id") > 1234).alias("y"))
    found = sketch_columns(df, [F.col("x")], F.col("y"), 10)
    assert found.rows == 5000 and found.positives == 3765 and len(found.cuts[0]) == 9
    assert all(abs(cut - 500 * (i + 1)) < 30 for i, cut in enumerate(found.cuts[0]))
    binned = with_bins(df, [F.col("x")], found).groupBy("bin0").count().collect()
    assert len(binned) == 10 and max(r["count"] for r in binned) < 600


def test_training_and_scoring_give_a_row_the_same_batch(spark, separable, monkeypatch):
    seen = {}

    def record(stage, model, *rest):
        seen[len(seen)] = stage.count()
        model.trees.append(None)

    monkeypatch.setattr(boosting, "_train_stage", record)
    monkeypatch.setattr(boosting.TreeEnsemble, "as_model", lambda self, spark: None)
    options = {"predictors": ["l_quantity", "l_discount"], "target": "target", "params": {}, "key": ["id"], "batches": 7}
    train_gbt_incremental(separable, **options)
    wanted = separable.select(F.pmod(key_hash(["id", "l_quantity", "l_discount"], 42), F.lit(7)).alias("b")).groupBy("b").count()
    assert seen == {r.b: r["count"] for r in wanted.collect()}
    monkeypatch.undo()
    model = train_gbt_incremental(separable, rounds=1, **options)
    scored = score_table(model, separable, target="target", batches=7, key=["id"])
    assert {r.batch_id: r["count"] for r in scored.groupBy("batch_id").count().collect()} == seen


def test_training_reads_key_and_role_columns_only(spark, tmp_path):
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumn("target", F.col("l_quantity") > 20)
    read = []
    original = boosting.materialize

    def record(df, label, *rest, **options):
        if label == "values":
            read.append(df._jdf.queryExecution().executedPlan().toString())
        return original(df, label, *rest, **options)

    boosting.materialize, params = record, {"max_depth": 1}
    try:
        train_gbt_incremental(lineitem, predictors=["l_tax"], target="target", params=params, batches=1, rounds=1, key=["l_orderkey", "l_linenumber"])
    finally:
        boosting.materialize = original
    assert re.search(r"ReadSchema: struct<(l_orderkey|l_linenumber|l_quantity|l_tax):\w+(,(l_orderkey|l_linenumber|l_quantity|l_tax):\w+){3}>", read[0])


def test_a_model_that_is_not_written_to_the_end_leaves_the_earlier_one(spark, small, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    first, second = (
        train_gbt(small, predictors=["feature1"], target="target", params={"eta": eta}, max_iter=1, key=["id"]) for eta in (0.1, 0.9)
    )

    def scores(model):
        return [r.final_score for r in model.score(small).orderBy("id").collect()]

    save_model(first, path)

    def fail(folder):
        first.pipeline.write().save(f"{folder}/pipeline")
        raise RuntimeError("killed")

    monkeypatch.setattr(second, "_write", fail)
    with pytest.raises(RuntimeError, match="killed"):
        save_model(second, path)
    assert scores(load_model(spark, path)) == scores(first)
    monkeypatch.undo()
    save_model(second, path)
    assert scores(load_model(spark, path)) == scores(second) != scores(first)
    assert len(list((tmp_path / "model" / "versions").iterdir())) == 1
