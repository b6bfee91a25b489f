"""Splitting a labelled table by date into train, validation and test parts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from sparkexp.functions.columns import as_boolean, col, comparable_date, parse_date, text_range

# The names of the parts in tables and in the report.
SPLITS = ("train", "val", "test")
PERIODS = {"train": "Train", "val": "Validation", "test": "Test"}

# The texts of the errors callers match on.
NO_INPUT = "No data found in the input dataset."
NO_ROWS = {
    "train": "No data found in the train dataset. Check your parameters !",
    "val": "No data found in the validation dataset. Check your parameters !",
    "test": "No data found in the test dataset. Check your parameters !",
}


@dataclass(frozen=True)
class SplitBounds:
    """The dates at which the parts begin, and the nominal end of the test part."""

    start: date
    val_start: date
    test_start: date
    end: date

    def span(self, split: str) -> tuple[date, date]:
        return {
            "train": (self.start, self.val_start),
            "val": (self.val_start, self.test_start),
            "test": (self.test_start, self.end),
        }[split]


def bounds_from_dates(
    start: str | date | datetime, end: str | date | datetime, val_weeks: int = 4, test_weeks: int = 4
) -> SplitBounds:
    """Count the test weeks back from the end, and the validation weeks back from there."""
    if val_weeks < 0 or test_weeks < 0:
        raise ValueError("The validation and test sizes cannot be negative.")
    last = parse_date(end)
    test_start = last - timedelta(weeks=test_weeks)
    return SplitBounds(parse_date(start), test_start - timedelta(weeks=val_weeks), test_start, last)


def date_bounds(df: DataFrame, datetime_col: str, lenient: bool = False) -> DataFrame:
    """One row with the first and last date of the table."""
    when = comparable_date(df, datetime_col, lenient)
    return df.agg(
        F.min(when).cast("date").alias("min_date"),
        F.max(when).cast("date").alias("max_date"),
    )


def resolve_bounds(
    df: DataFrame,
    datetime_col: str,
    start: str | date | datetime | None = None,
    end: str | date | datetime | None = None,
    val_weeks: int = 4,
    test_weeks: int = 4,
    lenient: bool = False,
) -> SplitBounds:
    """The bounds of the parts; the table is only read when a date is missing."""
    if start is None or end is None:
        found = date_bounds(df, datetime_col, lenient).first()
        if found.min_date is None and found.max_date is None:
            raise ValueError(NO_INPUT)
        start = found.min_date if start is None else start
        end = found.max_date if end is None else end
    return bounds_from_dates(start, end, val_weeks, test_weeks)


def split_conditions(
    df: DataFrame, datetime_col: str, bounds: SplitBounds, cap_test: bool = False, lenient: bool = False
) -> dict[str, Column]:
    """The condition for each part, as plain comparisons that reach the Parquet scan.

    The test part has no upper bound unless ``cap_test``. A null date meets
    no condition. The date literals take the type of the column, so for a
    timestamp without time zone the session's zone does not matter.
    """
    when = comparable_date(df, datetime_col, lenient)
    test = when >= F.lit(bounds.test_start)
    if cap_test:
        test = test & (when < F.lit(bounds.end + timedelta(days=1)))
    return {
        "train": (when >= F.lit(bounds.start)) & (when < F.lit(bounds.val_start)),
        "val": (when >= F.lit(bounds.val_start)) & (when < F.lit(bounds.test_start)),
        "test": test,
    }


def scanned(df: DataFrame, datetime_col: str, bounds: SplitBounds, splits: Sequence[str], cap_test: bool = False) -> DataFrame:
    """The table without rows whose text date cannot be in any of the parts, left out at the scan.

    Dates and timestamps are compared at the scan anyway, so such tables stay as they are. Text of other
    months is not parsed then; what counts rows (``prepare_experiment``, ``split_counts``) parses all.
    """
    ends = {"train": bounds.val_start, "val": bounds.test_start, "test": bounds.end + timedelta(days=1) if cap_test else None}
    ranges = [text_range(df, datetime_col, bounds.span(name)[0], ends[name]) for name in splits]
    if any(r is None for r in ranges):
        return df
    return df.where(reduce(or_, ranges))


def temporal_split(
    df: DataFrame, datetime_col: str, bounds: SplitBounds, cap_test: bool = False, lenient: bool = False
) -> DataFrame:
    """Add a ``split`` column; rows that are in no part get null."""
    conditions = split_conditions(df, datetime_col, bounds, cap_test, lenient)
    return df.withColumn("split", F.coalesce(*[F.when(c, F.lit(name)) for name, c in conditions.items()]))


def split_part(
    df: DataFrame,
    datetime_col: str,
    bounds: SplitBounds,
    split: str,
    cap_test: bool = False,
    lenient: bool = False,
) -> DataFrame:
    """One part of the table, filtered at the scan."""
    condition = split_conditions(df, datetime_col, bounds, cap_test, lenient)[split]
    return scanned(df, datetime_col, bounds, [split], cap_test).where(condition)


def split_counts(
    df: DataFrame, datetime_col: str, bounds: SplitBounds, cap_test: bool = False, lenient: bool = False
) -> DataFrame:
    """Rows of each part, in one pass and without a shuffle of rows."""
    return _per_split(df, datetime_col, bounds, cap_test, lenient).select("split", "row_count")


def split_spans(
    df: DataFrame, datetime_col: str, bounds: SplitBounds, cap_test: bool = False, lenient: bool = False
) -> DataFrame:
    """Name, first date, end date and size of each part: what a Gantt chart of the split shows."""
    return _per_split(df, datetime_col, bounds, cap_test, lenient).drop("split")


def _per_split(df: DataFrame, datetime_col: str, bounds: SplitBounds, cap_test: bool, lenient: bool) -> DataFrame:
    conditions = split_conditions(df, datetime_col, bounds, cap_test, lenient)
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
    rows = []
    for name in SPLITS:
        first, last = bounds.span(name)
        rows.append(
            F.struct(
                F.lit(name).alias("split"),
                F.lit(PERIODS[name]).alias("period"),
                F.lit(first).alias("start_date"),
                F.lit(last).alias("end_date"),
                F.col(name).alias("row_count"),
            )
        )
    return counted.select(F.inline(F.array(*rows)))


def cast_target(df: DataFrame, target_col: str, lenient: bool = False) -> DataFrame:
    """Make the target Boolean; other columns stay as they are."""
    return df.withColumn(target_col, as_boolean(col(target_col), lenient))


@dataclass(frozen=True)
class PreparedExperiment:
    """The outcome of :func:`prepare_experiment`; the three parts are lazy."""

    experiment_id: str
    bounds: SplitBounds
    train: DataFrame
    val: DataFrame
    test: DataFrame
    sizes: dict[str, int]
    spans: DataFrame


def prepare_experiment(
    data: DataFrame,
    *,
    target_col: str,
    datetime_col: str,
    experiment_id: str,
    start_date: str | date | None = None,
    end_date: str | date | None = None,
    val_size_weeks: int = 4,
    test_size_weeks: int = 4,
    cap_test: bool = False,
    lenient: bool = False,
) -> PreparedExperiment:
    """Split ``data`` by date; an empty table or part is an error.

    Reads the date column once: rows are counted by day, which tells first and last day and the sizes
    of all parts. There are as many counts as days.
    """
    day = comparable_date(data, datetime_col, lenient).cast("date").alias("day")
    by_day = {row.day: row["count"] for row in data.select(day).groupBy("day").count().collect()}
    days = [d for d in by_day if d is not None]
    if not by_day or not days and (start_date is None or end_date is None):
        raise ValueError(NO_INPUT)
    first, last = start_date or min(days), end_date or max(days)
    bounds = bounds_from_dates(first, last, val_size_weeks, test_size_weeks)
    conditions = split_conditions(data, datetime_col, bounds, cap_test, lenient)
    begins = {"train": bounds.start, "val": bounds.val_start, "test": bounds.test_start}
    ends = {"train": bounds.val_start, "val": bounds.test_start, "test": bounds.end + timedelta(days=1) if cap_test else None}
    sizes = {
        name: sum(by_day[d] for d in days if d >= begins[name] and (ends[name] is None or d < ends[name])) for name in SPLITS
    }
    for name in SPLITS:
        if sizes[name] == 0:
            raise ValueError(NO_ROWS[name])
    parts = {
        name: cast_target(scanned(data, datetime_col, bounds, [name], cap_test).where(condition), target_col, lenient)
        for name, condition in conditions.items()
    }
    spans = data.sparkSession.createDataFrame(
        [(PERIODS[name], *bounds.span(name), sizes[name]) for name in SPLITS],
        "period string, start_date date, end_date date, row_count long",
    )
    return PreparedExperiment(
        experiment_id, bounds, **parts, sizes=sizes, spans=spans
    )
