from __future__ import annotations

import sys

import pytest
from oracle_check import compare, connect

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


# Queries of this package itself; those for training text have tests of their own.
OWN = sorted(set(registry.queries()) - set(registry._text_queries()[0]))


def test_every_query_has_its_sql():
    assert set(OWN) <= set(registry.oracle_sql()) <= set(registry.queries())


def test_text_queries_are_optional(monkeypatch):
    monkeypatch.setitem(sys.modules, "sparkexp.llm", None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    assert sorted(registry.queries()) == sorted(registry.oracle_sql()) == OWN


def test_entry(spark):
    assert {r.period: r.row_count for r in registry.entry(spark).collect()} == {
        "Train": 1458,
        "Validation": 11,
        "Test": 31,
    }


@pytest.mark.parametrize("name", OWN)
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, name, SF_DIR) is None
