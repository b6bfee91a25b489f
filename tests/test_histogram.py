from __future__ import annotations

import numpy as np
import pytest

from sparkexp.operators.histogram import class_histograms, score_histogram


def table(spark, positives, negatives):
    rows = [(True, float(v)) for v in positives] + [(False, float(v)) for v in negatives]
    return spark.createDataFrame(rows, "y boolean, s double")


def compare(df, positive, values, bins=50):
    rows = score_histogram(df, "y", "s", positive, bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [r.bin for r in rows] == list(range(bins))
    assert [r.row_count for r in rows] == counts.tolist()
    np.testing.assert_allclose([r.low_edge for r in rows] + [rows[-1].high_edge], edges, rtol=1e-14, atol=1e-15)


@pytest.mark.parametrize("bins", [50, 7])
def test_agrees_with_numpy(spark, bins):
    rng = np.random.default_rng(3)
    positives, negatives = rng.random(400), np.round(rng.random(300), 2)
    df = table(spark, positives, negatives)
    compare(df, True, positives, bins)
    compare(df, False, negatives, bins)


def test_values_on_the_edges(spark):
    """Multiples of the bin width, where rounding decides the bin."""
    values = [i / 50 for i in range(51)] + [0.1 * i for i in range(11)]
    compare(table(spark, values, []), True, values)


def test_one_value_and_no_value(spark):
    df = table(spark, [0.3, 0.3], [])
    compare(df, True, [0.3, 0.3])
    empty = score_histogram(df, "y", "s", positive=False).orderBy("bin").collect()
    assert [r.row_count for r in empty] == [0] * 50
    assert (empty[0].low_edge, empty[-1].high_edge) == (0.0, 1.0)


def test_both_classes_in_one_pass(spark):
    rng = np.random.default_rng(4)
    positives, negatives = rng.normal(2, 1, 200), rng.normal(0, 3, 500)
    both = class_histograms(table(spark, positives, negatives), "y", "s").toPandas()
    assert len(both) == 100
    for side, values in ((True, positives), (False, negatives)):
        got = both[both.target == side].sort_values("bin").row_count.tolist()
        assert got == np.histogram(values, bins=50)[0].tolist()


def test_rows_without_label_are_left_out_and_missing_scores_are_refused(spark):
    df = spark.createDataFrame([(True, 0.1), (None, 5.0), (False, 0.2)], "y boolean, s double")
    assert class_histograms(df, "y", "s").groupBy().sum("row_count").first()[0] == 2
    for odd in (None, float("nan"), float("inf")):
        with pytest.raises(ValueError, match="finite"):
            class_histograms(spark.createDataFrame([(True, 0.1), (True, odd)], "y boolean, s double"), "y", "s")
