from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkexp.operators.prefix import running_totals


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_agrees_with_pandas(spark, descending, by):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 != 0, (F.col("id") % 3).cast("string")).alias("k"),
        F.col("id").alias("o"),
        (F.col("id") * 7 % 11).alias("v"),
        F.floor(F.col("id") / 90).alias("b"),
    )
    got = running_totals(rows, bucket="b", order="o", sums=["v"], by=by, descending=descending, lead=["v"]).toPandas()
    want = rows.toPandas().sort_values("o", ascending=not descending)
    grouped = want.groupby(want["k"].fillna("none")) if by else want.groupby(lambda _: 0)
    want["cum_v"] = grouped["v"].cumsum()
    want["total_v"] = grouped["v"].transform("sum")
    want["next_v"] = grouped["v"].shift(-1)
    got, want = (frame.sort_values("o").reset_index(drop=True) for frame in (got, want))
    assert len(got) == 1000
    for column in ("cum_v", "total_v", "next_v"):
        pd.testing.assert_series_equal(got[column], want[column], check_dtype=False)


def test_no_task_gets_all_rows(spark):
    """The only exchange to a single partition carries one row per bucket."""
    rows = spark.range(1000).select(F.col("id").alias("o"), F.lit(1).alias("v"), F.floor(F.col("id") / 10).alias("b"))
    plan = running_totals(rows, bucket="b", order="o", sums=["v"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1
    assert "HashAggregate(keys=[b" in lines[single[0] + 1]
