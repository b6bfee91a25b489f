from __future__ import annotations

import numpy as np
import pytest
from sql_check import SF_DIR

from sparkexp.llm import language_id as L, queries


def test_trigrams():
    grams, counts = L.trigrams("Ab--aB!")
    text = " ab ab "
    wanted: dict[int, int] = {}
    for i in range(len(text) - 2):
        gram = ord(text[i]) << 42 | ord(text[i + 1]) << 21 | ord(text[i + 2])
        wanted[gram] = wanted.get(gram, 0) + 1
    assert dict(zip(grams.tolist(), counts.tolist())) == wanted
    for text in (None, "", " 12 -- "):
        assert len(L.trigrams(text)[0]) == 0


def test_bundles_agree_with_single_trigrams():
    encoder = L.Encoder(64, 3)
    text = "hello world, hello"
    grams, counts = L.trigrams(text)
    wanted = sum(c * encoder._gram(g).astype(int) for g, c in zip(grams.tolist(), counts.tolist()))
    assert (L._bundles(encoder, [text, None])[0] == wanted).all()
    assert not L._bundles(encoder, [text, None])[1].any()


def test_held_out_accuracy_on_the_test_tables(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op9_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == L.held_out_by_crc(r.doc_id) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_training_adds_up_over_partitions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    one, many = L.train_profiles(docs.coalesce(1), dimensions=64), L.train_profiles(docs.repartition(7), dimensions=64)
    assert one.keys() == many.keys() and all((one[k] == many[k]).all() for k in one)


@pytest.mark.parametrize("table", ["messy", "clashing", "empty"])
def test_odd_rows(spark, table, request):
    docs = request.getfixturevalue(table)
    profiles = L.train_profiles(docs)
    found = L.identify(docs, profiles).collect()
    assert len(found) == docs.count()
    for row in found:
        if row.text is None or not any(c.isalpha() for c in row.text):
            assert (row.lang_pred, row.score) == ("und", 0.0)
        else:
            assert row.lang_pred in profiles and 0 < row.score <= 1


def test_without_training_rows(messy):
    assert {r.lang_pred for r in L.identify(messy, {}).collect()} == {"und"}
    same = {"a": np.ones(L.DIMENSIONS), "b": np.ones(L.DIMENSIONS)}
    rows = L.identify(messy, same).where("score > 0").collect()
    assert {r.lang_pred for r in rows} == {"a"} and {round(r.score, 6) for r in rows} == {0.5}
