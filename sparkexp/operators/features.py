"""Turning predictor columns into the finite numbers the trees decide on."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.ml.feature import Imputer, SQLTransformer
from pyspark.sql import DataFrame, functions as F

from sparkexp.functions.columns import col, is_number

FEATURES = "_sx_features"
PREFIX = "_sx_"
# Largest finite double: infinite predictor values count as this.
FINITE = sys.float_info.max

# Relative error in the rank of the medians; smaller is nearer the exact median and dearer.
MEDIAN_ERROR = 0.0001


def refuse_working_names(columns: Sequence[str]) -> None:
    """Refuse columns that would be taken for the working columns of the feature steps."""
    taken = [name for name in columns if name.startswith(PREFIX)]
    if taken:
        raise ValueError(f"Names that begin with '{PREFIX}' are used inside: {', '.join(taken)}.")


def _as_double(name: str) -> str:
    quoted = "`" + name.replace("`", "``") + "`"
    return f"nullif(CAST({quoted} AS DOUBLE), CAST('NaN' AS DOUBLE))"


def finite_double(name: str) -> str:
    """SQL text of a predictor as a finite double; null where it is missing."""
    value = _as_double(name)
    return f"CASE WHEN {value} IS NOT NULL THEN least(greatest({value}, {-FINITE!r}D), {FINITE!r}D) END"


def median_stages(
    train: DataFrame, predictors: Sequence[str], median_error: float = MEDIAN_ERROR
) -> tuple[list, list[str]]:
    """Fitted steps that fill gaps, and the SQL texts of the columns the trees then see.

    A missing value becomes the median of the training rows, whose rank is off by
    ``median_error`` of the rows at most. A predictor that has gaps in training also gets a
    column that says where they were. One without any value stays empty, and no tree splits on it.
    """
    counts = train.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(is_number(col(name).cast("double"))).alias(f"n{i}") for i, name in enumerate(predictors)],
    ).first()
    whole = [i for i in range(len(predictors)) if counts[f"n{i}"]]
    texts = ", ".join(f"{finite_double(predictors[i])} AS {PREFIX}v{i}" for i in whole)
    stages, values = [], []
    if whole:
        stages.append(SQLTransformer(statement=f"SELECT *, {texts} FROM __THIS__"))
        imputer = Imputer(
            inputCols=[f"{PREFIX}v{i}" for i in whole],
            outputCols=[f"{PREFIX}f{i}" for i in whole],
            strategy="median",
            relativeError=median_error,
        )
        stages.append(imputer.fit(stages[0].transform(train)))
    for i, name in enumerate(predictors):
        values.append(f"{PREFIX}f{i}" if i in whole else "CAST(NULL AS DOUBLE)")
    values += [f"CAST({PREFIX}v{i} IS NULL AS DOUBLE)" for i in whole if counts[f"n{i}"] < counts.total]
    return stages, values


def impute_missing(df: DataFrame, columns: Sequence[str], median_error: float = MEDIAN_ERROR) -> DataFrame:
    """Add ``<column>_missing`` (0 or 1) and ``<column>_filled`` (median where missing) for each column.

    The rank of the median is off by ``median_error`` of the rows at most.
    """
    refuse_working_names(df.columns)
    summary = df.agg(
        *[F.count_if(is_number(col(c).cast("double"))).alias(f"n{i}") for i, c in enumerate(columns)]
    ).first()
    empty = [c for i, c in enumerate(columns) if summary[f"n{i}"] == 0]
    if empty:
        raise ValueError(f"No value to take a median of in: {', '.join(empty)}.")
    flagged = df.withColumns(
        {f"{c}_missing": F.expr(f"CAST({_as_double(c)} IS NULL AS INT)") for c in columns}
        | {f"{PREFIX}{i}": F.expr(_as_double(c)) for i, c in enumerate(columns)}
    )
    names = [f"{PREFIX}{i}" for i in range(len(columns))]
    imputer = Imputer(inputCols=names, outputCols=[f"{c}_filled" for c in columns], strategy="median", relativeError=median_error)
    return imputer.fit(flagged).transform(flagged).drop(*names)


def drop_working_columns(df: DataFrame) -> DataFrame:
    """Remove the columns the feature steps added."""
    return df.select(*[col(c) for c in df.columns if not c.startswith(PREFIX)])
