from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from messy import messy_rows

from sparkexp.llm import fill_middle as M
from sql_check import sql_difference


def expected(doc_id, text):
    """One document, by the definition."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(mark in text for mark in M.MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows_of(table):
    return sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in table.collect()], key=repr)


EXTRA = [(100 + i, t, None, None, None) for i, t in enumerate(["<P>", "a<S>b", "x<M", "<", ">", "P>", "𝄞é€a" * 700, "é" * 5001, "\x00\x01", "<P" * 400])]


@pytest.mark.parametrize("part", [50, 2_000_000])
def test_agrees_with_the_definition(spark, messy, part):
    docs = messy.unionByName(spark.createDataFrame(EXTRA, messy.schema))
    got = rows_of(M.fill_in_middle(docs, part_bytes=part))
    assert got == sorted([(r[0], *expected(r[0], r[1])) for r in [*messy_rows(), *EXTRA]], key=repr)


def test_every_text_is_restored(spark, messy):
    docs = messy.unionByName(spark.createDataFrame(EXTRA, messy.schema))
    made = M.fill_in_middle(docs)
    back = made.withColumn("back", M.restore(made.output, made.form)).collect()
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    assert all(r.back == (r.text or "") for r in back)


def test_units_and_pieces():
    lists = M.split_units(pa.array(["", "aé", "𝄞", "", "xyz"]).slice(1))
    assert lists.to_pylist() == [["a", "é"], ["𝄞"], [], ["x", "y", "z"]]
    assert M.split_units(pa.array([], pa.string())).to_pylist() == []
    assert M.split_units(pa.array(["", ""])).to_pylist() == [[], []]
    none = np.array([], np.int64)
    assert [len(c) for c in M.transform_batch(pa.array([], pa.string()), none, none, none, none)] == [0] * 5


def test_empty_table_and_clashing_columns(spark, messy, empty):
    assert M.fill_in_middle(empty).count() == 0
    odd = messy.selectExpr("*", "'own' AS FORM", "'own' AS output", "'own' AS kept")
    out = M.fill_in_middle(odd)
    assert out.columns == [*messy.columns, "kept", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert {r.kept for r in out.collect()} == {"own"} and rows_of(out) == rows_of(M.fill_in_middle(messy))
    assert M.fill_in_middle(messy, keep=["doc_id"]).columns[0] == "doc_id"


def test_query_agrees_with_sql(spark):
    assert sql_difference(spark, "op11_fill_middle") is None
