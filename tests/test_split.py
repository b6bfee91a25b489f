from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from sparkexp.functions.columns import text_range
from sparkexp.operators import split
from sparkexp.operators.split import (
    bounds_from_dates,
    cast_target,
    date_bounds,
    prepare_experiment,
    resolve_bounds,
    split_counts,
    split_part,
    split_spans,
    temporal_split,
)

ROWS = [
    ("2023-01-01", False, "id1"),
    ("2023-01-02", False, "id2"),
    ("2023-02-03", True, "id3"),
    ("2023-03-04", True, "id4"),
]
SCHEMA = "datetimeCol string, targetCol boolean, id string"
TRAIN_EMPTY = "No data found in the train dataset. Check your parameters !"
VAL_EMPTY = "No data found in the validation dataset. Check your parameters !"


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def prepare(df, **options):
    return prepare_experiment(df, target_col="targetCol", datetime_col="datetimeCol", experiment_id="e", **options)


@pytest.mark.parametrize(
    ("start", "end", "weeks", "message"),
    [
        ("2023-01-01", "2023-01-04", 1, TRAIN_EMPTY),
        (None, "2023-01-04", 1, TRAIN_EMPTY),
        ("2023-01-01", None, 1, VAL_EMPTY),
        ("2023-01-05", "2023-01-06", 1, TRAIN_EMPTY),
        ("2023-01-01", "2023-01-04", 0, VAL_EMPTY),
    ],
)
def test_empty_parts_are_errors(data, start, end, weeks, message):
    with pytest.raises(ValueError) as error:
        prepare(data, start_date=start, end_date=end, val_size_weeks=weeks, test_size_weeks=weeks)
    assert str(error.value) == message


def test_empty_test_part_is_an_error(data):
    with pytest.raises(ValueError, match="test dataset"):
        prepare(data, start_date="2023-01-01", end_date="2023-03-10", val_size_weeks=8, test_size_weeks=0)


@pytest.mark.parametrize("dates", [{}, {"start_date": "2023-01-01", "end_date": "2023-02-01"}])
def test_empty_input_is_an_error(spark, dates):
    with pytest.raises(ValueError) as error:
        prepare(spark.createDataFrame([], SCHEMA), val_size_weeks=1, test_size_weeks=1, **dates)
    assert str(error.value) == "No data found in the input dataset."


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz"])
def test_default_bounds_for_every_date_type(data, kind):
    prepared = prepare(data.withColumn("datetimeCol", F.col("datetimeCol").cast(kind)))
    ids = [[row.id for row in part.orderBy("id").collect()] for part in (prepared.train, prepared.val, prepared.test)]
    assert ids == [["id1", "id2"], ["id3"], ["id4"]]
    assert prepared.sizes == {"train": 2, "val": 1, "test": 1}


def test_spans_are_those_of_a_gantt_chart(spark, data):
    bounds = resolve_bounds(data, "datetimeCol")
    expected = spark.createDataFrame(
        [
            ("Train", date(2023, 1, 1), date(2023, 1, 7), 2),
            ("Validation", date(2023, 1, 7), date(2023, 2, 4), 1),
            ("Test", date(2023, 2, 4), date(2023, 3, 4), 1),
        ],
        "period string, start_date date, end_date date, row_count long",
    )
    spans = split_spans(data, "datetimeCol", bounds)
    assertDataFrameEqual(spans, expected, ignoreNullable=True)
    assertDataFrameEqual(prepare(data).spans, expected, ignoreNullable=True)


def test_parts_are_disjoint_and_null_dates_are_in_none(spark):
    days = spark.range(400).select(
        F.when(F.col("id") % 50 != 7, F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int"))).alias("d")
    )
    bounds = bounds_from_dates("2023-02-01", "2023-12-31", 4, 8)
    labelled = temporal_split(days, "d", bounds)
    assert labelled.where("d IS NULL AND split IS NOT NULL").count() == 0
    counts = {row.split: row.row_count for row in split_counts(days, "d", bounds).collect()}
    for name, count in counts.items():
        part = split_part(days, "d", bounds, name)
        assert part.count() == count == labelled.where(F.col("split") == name).count()
    outside = labelled.where("split IS NULL AND d IS NOT NULL")
    assert outside.agg(F.max("d")).first()[0] == date(2023, 1, 31)
    assert labelled.where("split = 'test'").agg(F.max("d")).first()[0] > bounds.end


def test_capped_test_part_ends_with_the_last_day(spark):
    rows = [(datetime(2023, 3, 4, 23, 59),), (datetime(2023, 3, 5, 0, 0),)]
    df = spark.createDataFrame(rows, "d timestamp")
    bounds = bounds_from_dates("2023-01-01", "2023-03-04")
    assert split_part(df, "d", bounds, "test").count() == 2
    assert split_part(df, "d", bounds, "test", cap_test=True).count() == 1


def test_rows_before_the_start_enter_validation_when_the_windows_reach_further_back(data):
    bounds = bounds_from_dates("2023-01-02", "2023-01-05", 1, 0)
    assert [row.id for row in split_part(data, "datetimeCol", bounds, "val").orderBy("id").collect()] == ["id1", "id2"]


def test_date_filters_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    part = split_part(events, "ts", bounds_from_dates("2024-01-01", "2024-01-30", 1, 1), "val").select("event_id")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-16T00:00), LessThan(ts,2024-01-23T00:00)]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_bad_arguments(data):
    with pytest.raises(ValueError, match="negative"):
        bounds_from_dates("2023-01-01", "2023-02-01", -1, 1)
    with pytest.raises(ValueError, match="not a date"):
        date_bounds(data, "targetCol")
    with pytest.raises(ValueError):
        bounds_from_dates("01/02/2023", "2023-02-01")


def test_text_that_is_no_date_raises_unless_lenient(spark):
    df = spark.createDataFrame([("2023-01-01",), ("soon",)], "d string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        date_bounds(df, "d").collect()
    assert date_bounds(df, "d", lenient=True).first() == (date(2023, 1, 1), date(2023, 1, 1))


def test_cast_target(spark):
    df = spark.createDataFrame([("true", 1), ("no", 0), (None, None)], "word string, number int")
    assert [r.word for r in cast_target(df, "word").collect()] == [True, False, None]
    assert [r.number for r in cast_target(df, "number").collect()] == [True, False, None]
    odd = spark.createDataFrame([("maybe",)], "word string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_target(odd, "word").collect()
    assert cast_target(odd, "word", lenient=True).first().word is None


def pushed(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return re.search(r"PushedFilters: (\[.*?\])", df._jdf.queryExecution().executedPlan().toString()).group(1)


def test_text_dates_are_filtered_at_the_scan(spark, tmp_path):
    days = [f"{2020 + i // 365}-{1 + i % 12:02d}-{1 + i % 28:02d}" for i in range(1500)]
    spark.createDataFrame([(d, True) for d in days], "day string, target boolean").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    bounds = split.bounds_from_dates("2020-03-01", "2023-06-30", 8, 8)
    for name in split.SPLITS:
        part = split.split_part(table, "day", bounds, name, cap_test=True)
        filters = pushed(part)
        start, end = bounds.span(name)
        assert "GreaterThanOrEqual(day,2020-03" in filters if name == "train" else "GreaterThanOrEqual(day,2023-" in filters
        last = end if name == "test" else end - timedelta(days=1)
        assert sorted(r.day for r in part.collect()) == sorted(d for d in days if str(start) <= d <= str(last))
    assert "GreaterThanOrEqual(day,2023-" in pushed(split.split_part(table, "day", bounds, "test"))


@pytest.mark.parametrize(("start", "end"), [("2022-01-05", "2023-02-10"), ("2022-10-02", "2022-12-31"), ("2022-03-01", "2022-09-30"), ("2023-01-01", None)])
def test_no_spelling_of_a_date_is_lost(spark, start, end):
    """Whatever a cast takes for a date in the range meets the condition on the text."""
    rng, first = random.Random(1), date(2021, 12, 1)
    texts = []
    for i in range(500):
        d = first + timedelta(days=i)
        texts += [str(d), f"{d.year}-{d.month}-{d.day}", f"{d.year}-{d.month:02d}-{d.day}", f" {d}", f"{d}T01:02", f"{d} x", f"0{d}", f"+{d}", f"{d}\t"]
        if d.day == 1:
            texts += [f"{d.year}-{d.month}", f"{d.year}-{d.month:02d}", f"{d.year}-{d.month} "]
        if d.day == d.month == 1:
            texts += [f"{d.year}", f"{d.year} "]
    rng.shuffle(texts)
    df = spark.createDataFrame([(t,) for t in texts], "day string")
    low, high = date.fromisoformat(start), date.fromisoformat(end) if end else None
    when = F.col("day").try_cast("date")
    inside = (when >= F.lit(low)) & (when < F.lit(high) if high else F.lit(True))
    wanted = df.where(inside).count()
    assert wanted > 100 and df.where(text_range(df, "day", low, high)).where(inside).count() == wanted
    assert df.where(text_range(df, "day", low, high)).count() < df.count()


def test_malformed_text_raises(spark):
    rows = [(f"2023-{1 + i % 12:02d}-01", True) for i in range(24)]
    for bad in ("soon", "2023-13-01", "2019-99-99", "zzz"):
        df = spark.createDataFrame([*rows, (bad, True)], "day string, target boolean")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
            split.prepare_experiment(df, target_col="target", datetime_col="day", experiment_id="e", start_date="2023-01-01", end_date="2023-12-01")
    bounds = split.bounds_from_dates("2023-01-01", "2023-12-01")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        split.split_part(spark.createDataFrame([*rows, ("soon", True)], "day string, target boolean"), "day", bounds, "val").collect()
