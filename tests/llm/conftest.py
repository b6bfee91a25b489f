from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from messy import DOCS, messy_rows  # noqa: E402


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(messy):
    """Extra columns whose names the operators use themselves."""
    names = ["n_words", "spans", "items", "kept", "shard", "slot", "class", "score", "lang_pred", "secrets", "ids", "_class", "length", "LLR"]
    return messy.selectExpr("*", *[f"'own' AS `{n}`" for n in names])
