"""A synthetic labelled table, made on the executors from built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the generated table.
FIRST_DAY = "2023-01-01"
DAYS = 365
VALUE_LOW, VALUE_SPAN = 10, 990
FEATURE1_LOW, FEATURE1_HIGH = 1, 1000
FEATURE2_LOW, FEATURE2_HIGH = 3, 777


def with_synthetic_columns(df: DataFrame, id_column: str = "id", ratio: float = 0.001, seed: int = 42) -> DataFrame:
    """Add the six generated columns to any table that has a whole-number id.

    All depend on the id and the seed alone, so the table is the same however
    it is laid out. ``reference``, ``feature1`` and ``feature2`` come from an md5 of the two.
    """
    if not 0 < ratio <= 1:
        raise ValueError("ratio must be in (0, 1].")
    ident = F.col(id_column)
    every = int(1 / ratio)
    value = VALUE_LOW + VALUE_SPAN * F.pmod(ident, F.lit(10)).cast("double") / 10
    width = FEATURE2_HIGH - FEATURE2_LOW + 1

    def drawn(number: int) -> Column:
        """A number from 0 to below 1, on a grid of 2 ** -32."""
        text = F.concat(ident.cast("string"), F.lit(f"|{seed}|{number}"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)

    name = F.md5(F.concat(ident.cast("string"), F.lit(f"|{seed}|0")))
    parts = [F.substring(name, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return df.withColumns(
        {
            "reference": F.concat_ws("-", *parts),
            "otherValue": F.round(value, 2).cast("float"),
            "datetimeCol": F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(ident, F.lit(DAYS)).cast("int")),
            "feature1": (drawn(1) * (FEATURE1_HIGH - FEATURE1_LOW) + FEATURE1_LOW).cast("float"),
            "feature2": (F.floor(drawn(2) * width) + FEATURE2_LOW).cast("int"),
            "targetCol": F.pmod(ident, F.lit(every)) == 0,
        }
    )


def synthetic_labeled(spark: SparkSession, rows: int = 100_000, ratio: float = 0.001, seed: int = 42) -> DataFrame:
    """A labelled table of ``rows`` rows; one in ``1/ratio`` is positive."""
    return with_synthetic_columns(spark.range(rows), "id", ratio, seed)
