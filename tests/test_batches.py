from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkexp.operators import batches
from sparkexp.operators.batches import assign_batches, batch_ledger, deal_batches, num_batches, num_batches_table
from sparkexp.sources.scratch import discard


def test_number_of_batches(spark):
    assert [num_batches(n, 1000) for n in (0, 1, 1000, 1001, 76720)] == [0, 1, 1, 2, 77]
    assert num_batches(76720, 5000) == 16
    assert tuple(num_batches_table(spark.range(1001), 1000).first()) == (1001, 1000, 2)
    with pytest.raises(ValueError, match="cannot hold 0 rows"):
        num_batches(10, 0)


def test_every_row_is_in_one_batch_of_about_equal_size(spark):
    batched = assign_batches(spark.range(20_000), "id", 1000)
    assert batched.count() == batched.select("id").distinct().count() == 20_000
    sizes = {row.batch_id: row["count"] for row in batched.groupBy("batch_id").count().collect()}
    assert sorted(sizes) == list(range(20))
    assert all(850 < size < 1150 for size in sizes.values())


def test_batches_do_not_depend_on_the_layout_but_on_the_seed(spark):
    rows = spark.range(500)
    one = {r.id: r.batch_id for r in assign_batches(rows.repartition(7), "id", 50).collect()}
    other = {r.id: r.batch_id for r in assign_batches(rows.coalesce(1), "id", 50).collect()}
    reseeded = {r.id: r.batch_id for r in assign_batches(rows, "id", 50, seed=1).collect()}
    assert one == other != reseeded
    by_hand = {i: int(hashlib.md5(f"{len(str(i))}:{i}|42".encode()).hexdigest()[:15], 16) % 10 for i in range(500)}
    assert one == by_hand


def test_all_columns_are_the_key_by_default(spark):
    rows = spark.createDataFrame([("a", None), ("a", 1.0), (None, 1.0)], "k string, v double")
    batched = assign_batches(rows, None, 1)
    assert batched.count() == 3 and batched.where("batch_id IS NULL").count() == 0


def test_empty_table(spark):
    assert assign_batches(spark.range(0), "id", 10).collect() == []


def test_ledger(spark):
    rows = spark.range(100).select(
        (F.col("id") % 4).alias("batch_id"),
        F.when(F.col("id") < 90, F.col("id") % 3 == 0).alias("y"),
    )
    ledger = batch_ledger(rows, "y").orderBy("batch_id").collect()
    assert [r.row_count for r in ledger] == [25] * 4
    assert [r.running_rows for r in ledger] == [25, 50, 75, 100]
    assert [r.percent_done for r in ledger] == [25.0, 50.0, 75.0, 100.0]
    assert sum(r.positives for r in ledger) == 30
    assert sum(r.positives + r.negatives for r in ledger) == 90


def test_a_key_with_a_third_of_the_rows_fills_no_batch(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), "id")
    sizes = [r["count"] for r in assign_batches(rows, "key", 1000).groupBy("batch_id").count().collect()]
    assert len(sizes) == 30 and max(sizes) < 1.5 * 1000
    same = rows.select("key", F.lit(1).alias("id"))
    assert assign_batches(same, "key", 1000).where("key = -1").select("batch_id").distinct().count() == 1


def test_keys_that_read_alike_hash_apart(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a1:b", ""), (None, "n")], "x string, y string")
    assert assign_batches(rows, ["x", "y"], batches=2**40).select("batch_id").distinct().count() == 4


def test_a_third_of_equal_rows_is_dealt_evenly(spark):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, -1, id) AS id", "IF(id % 3 = 0, 'same', CAST(id AS STRING)) AS text").repartition(7)
    dealt, path = deal_batches(df, "id", 100)
    sizes = [r["count"] for r in dealt.groupBy("batch_id").count().collect()]
    assert sum(sizes) == 30_000 and len(sizes) == 100
    plain = assign_batches(df, "id", batches=100)
    # A value that occurs once has the batch it has without dealing.
    once = "id >= 0"
    assert sorted(dealt.where(once).collect()) == sorted(plain.where(once).select(dealt.columns).collect())
    same = [r["count"] for r in dealt.where("id < 0").groupBy("batch_id").count().collect()]
    assert max(same) == min(same) == 100
    whole, other = deal_batches(spark.range(20_000).selectExpr("IF(id % 3 = 0, -1, id % 3) AS id"), "id", 20)
    sizes = [r["count"] for r in whole.groupBy("batch_id").count().collect()]
    assert max(sizes) <= 1.1 * 1000
    for folder in (path, other):
        discard(spark, folder)


def test_dealing_moves_no_rows(spark, monkeypatch):
    monkeypatch.setattr(batches, "SECTION_VALUES", 1_000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 300)
    # Null and four values hold two thirds of the rows; the others occur once or twice. Python cannot read the interval.
    kind = "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN CAST(id % 4 AS STRING) ELSE CAST(id DIV 4 AS STRING) || 'x' END AS kind"
    rows = spark.range(60_000).selectExpr("id", kind, "INTERVAL '2' MONTH AS term").repartition(5)
    dealt, path = deal_batches(rows, "kind", 2**40, spread=[])
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("SortMergeJoin", "ShuffledHashJoin", "Window", "hashpartitioning"))
    found = dealt.drop("term").join(assign_batches(rows, "kind", batches=2**40, spread=[]).select("id", F.col("batch_id").alias("first")), "id").collect()
    assert sorted(r.id for r in found) == list(range(60_000))
    numbers = defaultdict(list)
    for row in found:
        numbers[row.kind].append((row.batch_id - row["first"]) % 2**40)
    assert all(sorted(n) == list(range(len(n))) for n in numbers.values())
    rare, other = deal_batches(rows, "kind", 2**40, spread=[], repeated_from=2)
    one = rare.where("kind LIKE '%x'").groupBy("kind").agg(F.countDistinct("batch_id").alias("n"))
    assert one.agg(F.max("n")).first()[0] == 1
    for folder in (path, other):
        discard(spark, folder)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
