"""Casts, date handling and row hashing, all as built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

DATE_FORMAT = "%Y-%m-%d"


def col(name: str) -> Column:
    """The column of exactly this name, also when the name holds a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def parse_date(value: str | date | datetime) -> date:
    """A calendar date from text such as ``2023-01-31``, a date or a timestamp."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.strptime(value, DATE_FORMAT).date()


def comparable_date(df: DataFrame, name: str, lenient: bool = False) -> Column:
    """The date column in a form that compares with a date literal.

    Date and timestamp columns are returned as they are, so that Spark can
    push the comparison into the Parquet scan. Text has to be cast first;
    a value that is not a date raises, or becomes null when ``lenient``.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return col(name)
    if isinstance(kind, StringType):
        return col(name).try_cast("date") if lenient else col(name).cast("date")
    raise ValueError(f"Column '{name}' is {kind.simpleString()}, not a date, timestamp or text column.")


def text_range(df: DataFrame, name: str, start: date, end: date | None) -> Column | None:
    """A condition on a text date's letters that every date from ``start`` to before ``end`` meets.

    It holds for other texts too and only saves reading: as a plain comparison it reaches the Parquet scan,
    which a cast does not. It looks at year and month, and lets pass what might be written in another
    way: months of one digit, and texts that begin with a blank, a sign, a zero or no digit. None
    where there is nothing to save.
    """
    last = date.max if end is None else end - timedelta(days=1)
    if df.schema[name].dataType != StringType() or start.year < 1000 or last < start:
        return None
    text, lower = col(name), f"{start:%Y-%m}" if start.month > 1 else f"{start:%Y}"
    within = text >= F.lit(lower)
    if end is not None:
        year = f"{last:%Y}"
        upper = f"{year}-{last.month + 1:02d}" if last.month < 12 else str(last.year + 1)
        short = ((text >= F.lit(f"{year}-1")) & (text < F.lit(f"{year}-10"))) | ((text >= F.lit(f"{year}-2")) & (text < F.lit(f"{year}-:")))
        within = within & ((text < F.lit(upper)) | short)
    return within | (text < F.lit("1")) | (text >= F.lit(":"))


def as_boolean(column: Column, lenient: bool = False) -> Column:
    """The column as a Boolean; words that are not Booleans raise, or become null when ``lenient``."""
    return column.try_cast("boolean") if lenient else column.cast("boolean")


def weeks_before(column: Column, weeks: int) -> Column:
    """The date ``weeks`` weeks earlier."""
    return F.date_sub(column, 7 * weeks)


def key_hash(keys: Sequence[str], seed: int) -> Column:
    """A 60-bit number that depends only on the key values and the seed.

    It uses md5 because every SQL engine has it, so that another engine can
    repeat the assignment. Each value is written after its length, so that no two
    keys read alike; null is ``n``. Row order and partitioning do not matter.
    """

    def written(name: str) -> Column:
        text = col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n"))

    salted = F.concat(*[written(k) for k in keys], F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(salted), 1, 15), 16, 10).cast("long")


def is_number(column: Column) -> Column:
    """True where a floating-point column holds neither null nor NaN."""
    return column.isNotNull() & ~F.isnan(column)


def is_finite(column: Column) -> Column:
    """True where a floating-point column holds neither null, NaN nor an infinity; never null itself."""
    return F.coalesce(F.abs(column) < F.lit(float("inf")), F.lit(False))
