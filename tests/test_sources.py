from __future__ import annotations

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from sparkexp.config import ExperimentPaths, map_params, new_run_id
from sparkexp.operators.batches import assign_batches
from sparkexp.sources import scratch, tables
from sparkexp.sources.synthetic import synthetic_labeled, with_synthetic_columns


def test_synthetic_table_follows_its_rules(spark):
    df = synthetic_labeled(spark)
    assert df.dtypes == [
        ("id", "bigint"),
        ("reference", "string"),
        ("otherValue", "float"),
        ("datetimeCol", "date"),
        ("feature1", "float"),
        ("feature2", "int"),
        ("targetCol", "boolean"),
    ]
    row = df.agg(
        F.count("*").alias("rows"),
        F.count_if("targetCol").alias("positives"),
        F.count_distinct("reference").alias("references"),
        F.min("datetimeCol").alias("first"),
        F.max("datetimeCol").alias("last"),
        F.min("feature1").alias("low1"),
        F.max("feature1").alias("high1"),
        F.min("feature2").alias("low2"),
        F.max("feature2").alias("high2"),
        F.count_distinct("feature2").alias("values2"),
    ).first()
    assert tuple(row)[:5] == (100_000, 100, 100_000, date(2023, 1, 1), date(2023, 12, 31))
    assert 1 <= row.low1 < 1.1 and 999.9 < row.high1 <= 1000
    assert (row.low2, row.high2, row.values2) == (3, 777, 775)
    values = [r[0] for r in df.select("otherValue").distinct().orderBy("otherValue").collect()]
    assert values == [10.0 + 99.0 * i for i in range(10)]


def test_synthetic_split_sizes(spark):
    """The sizes of the parts with the default table, by arithmetic on the dates."""
    from sparkexp.operators.split import bounds_from_dates, split_counts

    counts = split_counts(synthetic_labeled(spark), "datetimeCol", bounds_from_dates("2023-01-01", "2023-12-31", 4, 8))
    assert {r.split: r.row_count for r in counts.collect()} == {"train": 76_720, "val": 7_672, "test": 15_608}


def test_random_columns_stay_the_same_between_actions(spark):
    df = synthetic_labeled(spark, rows=1000)
    assert df.agg(F.sum("feature1"), F.max("reference")).first() == df.agg(F.sum("feature1"), F.max("reference")).first()
    other = synthetic_labeled(spark, rows=1000, seed=1)
    assert other.agg(F.sum("feature1")).first() != df.agg(F.sum("feature1")).first()
    with pytest.raises(ValueError, match="ratio"):
        synthetic_labeled(spark, ratio=0)


def test_a_table_is_never_overwritten(spark, tmp_path):
    df = synthetic_labeled(spark, rows=100)
    path = tables.write_table(df, ExperimentPaths(str(tmp_path)).dataset("20230101000000"))
    assertDataFrameEqual(tables.read_table(spark, path), df)
    assert tables.read_table(spark, path, ["id"]).columns == ["id"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_table(df, path)
    assert tuple(tables.table_shape(df).first()) == (100, 7)
    assert tables.preview(df).count() == 5


@pytest.mark.parametrize("folders", [True, False])
def test_predictions_round_trip_and_rerun_with_fewer_batches(spark, tmp_path, folders):
    path = ExperimentPaths(str(tmp_path)).predictions("0042", "val")
    rows = spark.range(1000).withColumn("final_score", F.col("id") / 1000)
    for batches in (10, 4):
        batched = assign_batches(rows, "id", batches=batches)
        tables.write_predictions(batched, path, batch_folders=folders)
        back = tables.read_predictions(spark, path, base_path=ExperimentPaths(str(tmp_path)).predictions_root)
        assert back.count() == 1000
        assert back.select("batch_id").distinct().count() == batches
        assert back.select("experiment_id", "prefix").distinct().collect() == [("0042", "val")]
        assertDataFrameEqual(back.select("id", "final_score", "batch_id"), batched)
        assert dict(back.dtypes)["batch_id"] == "bigint" and len(back.columns) == 5
    assert bool(glob.glob(f"{path}/batch_id=*")) == folders


def test_materialized_table_is_partitioned_and_can_be_removed(spark):
    df = spark.range(100).withColumn("b", F.col("id") % 3)
    stored, path = scratch.materialize(df, "test", partition_by="b")
    plan = stored.where("b = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(b" in plan
    assert stored.count() == 100 and path.startswith(scratch.scratch_root(spark))
    scratch.discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_paths_and_run_ids():
    paths = ExperimentPaths("s3a://bucket/x/")
    assert paths.model("e1") == "s3a://bucket/x/models/e1/gbt_trained.model"
    assert paths.predictions("e1", "val") == "s3a://bucket/x/data/batch_predictions/experiment_id=e1/prefix=val"
    assert paths.report("e1", "val", "metrics") == "s3a://bucket/x/reports/e1/val/metrics"
    assert len(new_run_id()) == 14 and new_run_id().isdigit()


def test_parameters():
    mapped = map_params({"max_depth": 1, "eta": 0.1, "subsample": 0.8, "colsample_bytree": 0.8, "nthread": 6})
    assert (mapped.max_depth, mapped.eta, mapped.subsample, mapped.colsample) == (1, 0.1, 0.8, 0.8)
    assert mapped.objective == "squared" and mapped.reg_lambda == 1.0
    assert any("nthread" in note for note in mapped.notes)
    assert map_params({"learning_rate": 0.2, "reg_lambda": 0}).eta == 0.2
    assert map_params({"objective": "binary:logistic"}).objective == "logistic"
    with pytest.warns(UserWarning, match="frobnicate"):
        map_params({"frobnicate": 1})
    with pytest.raises(ValueError, match="Objective"):
        map_params({"objective": "rank:pairwise"})


def test_a_key_on_a_third_of_all_rows_loses_no_row(spark, tmp_path):
    """Equal keys are told apart by the other columns; the table, its ledger and its folders stay whole."""
    from sparkexp.operators.batches import batch_ledger

    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), "id", (F.col("id") % 7 == 0).alias("y")
    )
    batched = assign_batches(rows, "key", batch_size=100)
    ledger = batch_ledger(batched, "y").agg(F.sum("row_count"), F.max("row_count"), F.max("running_rows")).first()
    assert ledger[0] == ledger[2] == 3000 and ledger[1] < 150
    tables.write_predictions(batched, str(tmp_path / "scored"), batch_folders=True)
    assertDataFrameEqual(tables.read_predictions(spark, str(tmp_path / "scored")).select("id", "y"), rows.select("id", "y"))


def test_synthetic_columns_do_not_depend_on_the_layout(spark):
    one, many = (synthetic_labeled(spark, rows=500).repartition(n) for n in (1, 7))
    again = with_synthetic_columns(spark.range(500).repartition(5))
    assert sorted(one.collect()) == sorted(many.collect()) == sorted(again.collect())
    made = one.agg(F.min("feature1"), F.max("feature1"), F.min("feature2"), F.max("feature2"), F.count_distinct("reference")).first()
    assert 1 <= made[0] < made[1] <= 1000 and 3 <= made[2] < made[3] <= 777 and made[4] == 500


@pytest.mark.parametrize("kind", ["predictions", "metrics"])
def test_a_job_that_fails_midway_leaves_the_earlier_table(spark, tmp_path, kind):
    def write(df):
        if kind == "predictions":
            return tables.write_predictions(df, str(tmp_path / "t"), by=["batch_id"])
        return tables.write_metrics(df, str(tmp_path / "t"))

    first = spark.range(10).selectExpr("id", "id % 2 AS batch_id")
    write(first)
    broken = first.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("killed"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="killed"):
        write(broken)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == list(range(10))
    write(first.where("id < 3"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [0, 1, 2]
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["t"]
