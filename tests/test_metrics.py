from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sparkexp.operators.metrics import (
    average_precision,
    binary_metrics,
    bucket_edges,
    class_scores,
    log_loss,
    roc_auc,
    roc_curve,
    target_counts,
)

SCHEMA = "y boolean, s double"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def by_hand(rows):
    """Log loss, AUC from all pairs, and average precision from the definition."""
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    eps = 2.0**-52
    loss = -np.mean([math.log(min(max(s if y else 1 - s, eps), 1 - eps)) for y, s in rows])
    if not pos or not neg:
        loss = None
    auc = None
    if pos and neg:
        auc = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg])
    ap, last = 0.0, 0.0
    for cut in sorted({s for _, s in rows}, reverse=True):
        tp, total = sum(s >= cut for s in pos), sum(s >= cut for _, s in rows)
        if pos:
            ap += (tp / len(pos) - last) * tp / total
            last = tp / len(pos)
    return loss, auc, ap


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert (a is None) == (b is None)
        assert a is None or a == pytest.approx(b, abs=1e-12)


def test_known_values(spark):
    df = frame(spark, [(False, 0.2), (True, 0.8), (False, 0.4), (True, 0.9)])
    row = binary_metrics(df, "y", "s").first()
    assert row.logloss == pytest.approx(0.26562, abs=1e-5)
    assert (row.auc, row.auprc) == (1.0, 1.0)
    assert log_loss(df, "y", "s").first().logloss == pytest.approx(row.logloss, abs=1e-15)
    assert roc_auc(df, "y", "s").first().auc == 1.0
    assert average_precision(df, "y", "s").first().auprc == 1.0


@pytest.mark.parametrize("rows_per_bucket", [3, 40, 10**6])
def test_agrees_with_the_definitions_across_buckets(spark, rows_per_bucket):
    rng = random.Random(5)
    rows = [(rng.random() < 0.3, round(rng.random(), 2)) for _ in range(300)]
    close(tuple(binary_metrics(frame(spark, rows), "y", "s", rows_per_bucket=rows_per_bucket).first()), by_hand(rows))


def test_one_score_holding_a_third_of_all_rows(spark):
    rng = random.Random(6)
    rows = [(i % 4 == 0, 0.5 if i % 3 == 0 else rng.random()) for i in range(600)]
    df = frame(spark, rows)
    edges = bucket_edges(df, "s", 20)
    assert len(edges) > 15 and edges == sorted(set(edges))
    close(tuple(binary_metrics(df, "y", "s", rows_per_bucket=20).first()), by_hand(rows))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 1.0])), min_size=1, max_size=25))
def test_any_small_table(spark, rows):
    close(tuple(binary_metrics(frame(spark, rows), "y", "s", rows_per_bucket=2).first()), by_hand(rows))


def test_monotone_change_of_scores_keeps_the_ranking_metrics(spark):
    rng = random.Random(7)
    df = frame(spark, [(rng.random() < 0.4, rng.random()) for _ in range(200)])
    plain = binary_metrics(df, "y", "s").first()
    stretched = binary_metrics(df.withColumn("s", F.exp(F.col("s") * 9) - 3), "y", "s").first()
    assert stretched.auc == plain.auc and stretched.auprc == pytest.approx(plain.auprc, abs=1e-12)
    assert stretched.logloss is None


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([(True, 0.5), (True, 0.7)], (None, None, 1.0)),
        ([(False, 0.5), (False, 0.7)], (None, None, 0.0)),
        ([(True, 0.5), (False, 0.5)], (math.log(2), 0.5, 0.5)),
        ([(True, 1.5), (False, 0.5)], (None, 1.0, 1.0)),
        ([(True, None), (False, 0.5), (True, 0.4)], (None, None, None)),
        ([(True, float("nan")), (False, 0.5), (True, 0.4)], (None, None, None)),
        ([(True, float("inf")), (False, 0.5), (True, 0.4)], (None, None, None)),
        ([(True, 0.4), (False, 0.5), (True, float("-inf"))], (None, None, None)),
        ([(None, 0.1), (False, 0.5), (True, 0.4)], (None, None, None)),
        ([], (None, None, None)),
    ],
)
def test_undefined_metrics_are_null_and_the_others_survive(spark, rows, expected):
    close(tuple(binary_metrics(frame(spark, rows), "y", "s").first()), expected)
    close(tuple(log_loss(frame(spark, rows), "y", "s").first()), expected[:1])


def test_scores_of_zero_and_one_are_clipped_by_the_type_of_the_score(spark):
    rows = [(True, 0.0), (False, 1.0)]
    assert log_loss(frame(spark, rows), "y", "s").first().logloss == pytest.approx(-math.log(2.0**-52))
    single = frame(spark, rows, "y boolean, s float")
    assert log_loss(single, "y", "s").first().logloss == pytest.approx(-math.log(2.0**-23))
    assert binary_metrics(single, "y", "s").first().logloss == pytest.approx(-math.log(2.0**-23))


def test_groups_also_with_null_key(spark):
    rows = [("a", True, 0.9), ("a", False, 0.1), (None, True, 0.2), (None, False, 0.3), ("b", True, 0.5)]
    df = frame(spark, rows, "k string, y boolean, s double")
    got = {r.k: (r.auc, r.auprc) for r in binary_metrics(df, "y", "s", by=["k"], rows_per_bucket=1).collect()}
    assert got == {"a": (1.0, 1.0), None: (0.0, 0.5), "b": (None, 1.0)}


def curve(df, **options):
    points = roc_curve(df, "y", "s", **options).orderBy(F.desc("threshold")).collect()
    return [(p.threshold, p.fpr, p.tpr) for p in points]


def test_curve_with_and_without_points_on_a_line(spark):
    df = frame(spark, [(True, 0.9), (True, 0.8), (False, 0.7), (False, 0.6), (True, 0.5)])
    inf, third = float("inf"), 1 / 3
    everything = [(inf, 0, 0), (0.9, 0, third), (0.8, 0, 2 / 3), (0.7, 0.5, 2 / 3), (0.6, 1, 2 / 3), (0.5, 1, 1)]
    for size in (1, 2, 1000):
        assert curve(df, drop_intermediate=False, rows_per_bucket=size) == everything
        assert curve(df, rows_per_bucket=size) == [everything[i] for i in (0, 1, 2, 4, 5)]


def test_curve_area_is_the_auc(spark):
    rng = random.Random(8)
    df = frame(spark, [(rng.random() < 0.4, round(rng.random(), 1)) for _ in range(200)])
    for options in ({"drop_intermediate": False}, {"rows_per_bucket": 10}):
        points = curve(df, **options)
        area = sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(points, points[1:]))
        assert area == pytest.approx(roc_auc(df, "y", "s").first().auc, abs=1e-12)


def test_curve_rates_are_null_without_a_class_or_with_missing_scores(spark):
    assert {p[1] for p in curve(frame(spark, [(True, 0.5), (True, 0.7)]))} == {None}
    assert {p[2] for p in curve(frame(spark, [(False, 0.5), (False, 0.7)]))} == {None}
    assert {p[1:] for p in curve(frame(spark, [(True, 0.5), (False, 0.7), (True, None)]))} == {(None, None)}


def test_target_counts(spark):
    rows = [(True, 0.1), (None, 0.2), (True, 0.3)]
    assert [tuple(r) for r in target_counts(frame(spark, rows), "y").collect()] == [(False, 0), (True, 2)]
    assert [tuple(r) for r in target_counts(frame(spark, []), "y").collect()] == [(False, 0), (True, 0)]


def test_class_scores_and_dotted_names(spark):
    df = frame(spark, [(True, 0.1), (False, 0.2), (None, 0.3)], "y boolean, `a.score` double")
    assert [r.score for r in class_scores(df, "y", "a.score").collect()] == [0.1]
    assert [r.score for r in class_scores(df, "y", "a.score", positive=False).collect()] == [0.2]
    assert binary_metrics(df.where("y IS NOT NULL"), "y", "a.score").first().auc == 0.0


def test_thousands_of_buckets_follow_the_rows(spark):
    rows = spark.range(20_000).select((F.col("id") / 20_000).alias("s"), (F.col("id") % 3 == 0).alias("y"))
    edges = bucket_edges(rows, "s", rows_per_bucket=4)
    assert len(edges) > 4_900
    fine = binary_metrics(rows, "y", "s", rows_per_bucket=4).first()
    coarse = binary_metrics(rows, "y", "s").first()
    assert all(a == pytest.approx(b, abs=1e-12) for a, b in zip(fine, coarse))
