from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkexp.config import ColumnRoles, ExperimentPaths
from sparkexp.operators.metrics import binary_metrics, roc_curve
from sparkexp.plans.evaluation import consolidate_report, evaluate
from sparkexp.plans.experiment import run_experiment
from sparkexp.sources.synthetic import synthetic_labeled
from sparkexp.sources.tables import read_predictions

SCHEMA = "target_col boolean, `xgb.final_score` double"


def test_evaluation_writes_its_tables(spark, tmp_path):
    rows = [(False, 0.2), (True, 0.8), (False, 0.4), (True, 0.9)]
    predictions = spark.createDataFrame(rows, SCHEMA)
    found = evaluate(predictions, target_col="target_col", score_col="xgb.final_score", output=str(tmp_path / "test"))
    stored = spark.read.parquet(str(tmp_path / "test" / "metrics")).first()
    assert stored.logloss == pytest.approx(0.26562, abs=1e-5)
    assert (stored.auc, stored.auprc) == (1.0, 1.0)
    assert found.metrics.first() == stored
    assert [tuple(r) for r in found.target_counts.orderBy("target").collect()] == [(False, 2), (True, 2)]
    assert found.score_histogram.count() == 100
    assert found.roc_curve.count() == 4


@pytest.mark.parametrize("rows_per_bucket", [50, 10**6])
def test_evaluation_agrees_with_the_single_operators(spark, rows_per_bucket):
    df = spark.range(3000).select(
        (F.rand(1) < 0.3).alias("y"), F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.rand(2)).alias("s")
    )
    df = spark.createDataFrame(df.toPandas())
    found = evaluate(df, target_col="y", score_col="s", rows_per_bucket=rows_per_bucket)
    assert found.metrics.first().asDict() == pytest.approx(binary_metrics(df, "y", "s").first().asDict(), abs=1e-12)
    key = ["threshold", "fpr", "tpr"]
    assert sorted(found.roc_curve.select(key).collect()) == sorted(roc_curve(df, "y", "s").select(key).collect())
    values = df.toPandas()
    for side in (True, False):
        got = [r.row_count for r in found.score_histogram.where(F.col("target") == side).orderBy("bin").collect()]
        assert got == np.histogram(values.s[values.y == side], bins=50)[0].tolist()


def test_evaluation_of_no_rows_or_missing_values(spark):
    with pytest.raises(ValueError) as error:
        evaluate(spark.createDataFrame([], SCHEMA), target_col="target_col", score_col="xgb.final_score")
    assert str(error.value) == "The predictions_data DataFrame is empty."
    rows = [(True, 0.1), (None, 0.3), (False, None)]
    with pytest.raises(ValueError, match="2 rows have no label or no score"):
        evaluate(spark.createDataFrame(rows, SCHEMA), target_col="target_col", score_col="xgb.final_score")


def test_evaluation_of_one_class(spark):
    rows = [(True, 0.1), (True, 0.3)]
    found = evaluate(spark.createDataFrame(rows, SCHEMA), target_col="target_col", score_col="xgb.final_score")
    assert tuple(found.metrics.first()) == (None, None, 1.0)
    assert [r.row_count for r in found.target_counts.orderBy("target").collect()] == [0, 2]


def test_whole_run(spark, tmp_path):
    paths = ExperimentPaths(str(tmp_path))
    data = synthetic_labeled(spark, rows=4000, ratio=0.2)
    roles = ColumnRoles(
        "targetCol", "datetimeCol", ("feature1", "feature2", "otherValue"), key=("id",), keep=("otherValue", "id", "datetimeCol")
    )
    done = run_experiment(
        data,
        roles,
        paths,
        params={"max_depth": 2, "eta": 0.3, "subsample": 0.8},
        start_date="2023-01-01",
        end_date="2023-12-31",
        val_size_weeks=4,
        test_size_weeks=8,
        batch_size=2000,
        rounds=2,
        experiment_id="20230101000000",
    )
    sizes = done.prepared.sizes
    for prefix in ("val", "test"):
        scored = read_predictions(spark, done.predictions[prefix])
        assert scored.count() == sizes[prefix]
        assert {"otherValue", "id", "datetimeCol", "targetCol", "final_score"} <= set(scored.columns)
        assert "feature1" not in scored.columns
        # Every fifth id is positive, which is also visible in otherValue.
        assert done.evaluations[prefix].metrics.first().auc > 0.9
    report = spark.read.parquet(done.report_path)
    assert {r[0] for r in report.select("experiment_id").distinct().collect()} == {"20230101000000"}
    sections = {r.section for r in report.select("section").distinct().collect()}
    assert sections == {"Experiment Details", "Validation Report", "Test Report"}
    spans = {r["item"]: (r.value, r.label) for r in report.where("section = 'Experiment Details'").collect()}
    assert spans["Train"] == (sizes["train"], "2023-01-01 to 2023-10-08")
    counts = report.where("section = 'Test Report' AND item IN ('target_counts', 'score_histogram')")
    totals = {r["item"]: r["sum(value)"] for r in counts.groupBy("item").sum("value").collect()}
    assert totals == {"target_counts": sizes["test"], "score_histogram": sizes["test"]}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        consolidate_report(spark, "another", paths)


def test_a_run_reads_the_raw_table_three_times(spark, tmp_path):
    """Once for the days, once for training and once for scoring."""
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        reads.add(1)
        yield from batches

    made = synthetic_labeled(spark, rows=4000, ratio=0.01).coalesce(1)
    made.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw")).coalesce(1)
    data = raw.mapInArrow(count, raw.schema)
    run_experiment(
        data,
        ColumnRoles("targetCol", "datetimeCol", ("feature1", "feature2"), key=("id",)),
        ExperimentPaths(str(tmp_path / "out")),
        params={"max_depth": 1},
        val_size_weeks=8,
        test_size_weeks=8,
        rounds=1,
        trainer="one_fit",
    )
    assert reads.value <= 3
