"""Each stage against brute force on its own input."""

from __future__ import annotations

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sql_check import SF_DIR
from test_decontaminate import brute as benchmark_hits
from test_ngram_join import groups
from tokenizers import Tokenizer

import __spark_entry__ as registry
from sparkexp.llm import secret_scan
from sparkexp.sources.scratch import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and what comes out of the last."""
    docs, tables = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        tables.append(docs)
        docs, _ = materialize(stage(spark, docs, SF_DIR), "stage")
    return [*tables, docs]


def test_columns_and_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "benchmark decontamination", "secret scan", "packing",
    ]
    assert all(table.columns == COLUMNS for table in stages[:-1])


def test_gibberish_and_unlearned_languages_go_however_many_are_learned(spark, stages):
    rng = random.Random(4)
    alphabets = {"a": "bcdfghjklmnpqrstvwxz", "b": "абвгдежзиклмнопрстуя", "c": "かきくけこさしすせそ"}
    strange = [
        (10**6 + i, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(60)), None, "s", 1)
        for i, letters in enumerate(alphabets.values())
    ]
    docs = stages[0]
    for languages in (["en", "fr"], ["en", "fr", "de", "es"]):
        known = docs.where(F.col("lang").isin(languages))
        kept = corpus_pipeline.identify_language(spark, known.unionByName(spark.createDataFrame(strange, docs.schema)), SF_DIR)
        ids = {r.doc_id for r in kept.collect()}
        assert not ids & {row[0] for row in strange}
        lettered = {r.doc_id for r in known.collect() if any(c.isalpha() for c in r.text)}
        assert len(lettered - ids) <= 0.01 * len(lettered)


@pytest.mark.parametrize("kind", ["messy", "clashing", "empty"])
def test_odd_tables_go_through_all_stages(spark, request, kind):
    """Nulls, repeated rows, long texts; columns named like an operator's own keep the user's values."""
    docs = request.getfixturevalue(kind)
    # A language to learn from in every row, and columns of names that the stages use.
    docs = docs.withColumn("lang", F.lit("xx"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, _ = materialize(stage(spark, docs, SF_DIR), "stage")
        assert out.columns == docs.columns
        before = {tuple(v for k, v in zip(docs.columns, r) if k not in ("text", "n_chars")) for r in docs.collect()}
        assert {tuple(v for k, v in zip(docs.columns, r) if k not in ("text", "n_chars")) for r in out.collect()} <= before
        docs = out
    kept = docs.count()
    assert (kept == 0) == (kind == "empty") and (kind == "empty" or {r.text for r in docs.collect()}.isdisjoint({None, ""}))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    whole = {(r.doc_id, r.doc_tokens) for r in pieces.collect()}
    assert len(whole) <= kept and (kept == 0 or sum(r.length for r in pieces.collect()) > 0)


def test_documents_with_letters_keep_their_place(stages):
    before, after = stages[0].collect(), {r.doc_id for r in stages[1].collect()}
    assert {r.doc_id for r in before if not any(c.isalpha() for c in r.text)}.isdisjoint(after)
    assert len(after) > 0.99 * len(before)


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    group, _ = groups(rows)
    least = {}
    for g, row in zip(group, rows):
        least[g] = min(least.get(g, row[0]), row[0])
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(least.values())


def test_benchmark_passages_go(spark, stages):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    after = {r.doc_id: r for r in stages[3].collect()}
    for row in stages[2].collect():
        words, hit, _ = benchmark_hits(row.text, items)
        if not hit:
            assert after[row.doc_id] == row
        elif hit > 0.5 * words:
            assert row.doc_id not in after
        else:
            assert len(after[row.doc_id].text) < len(row.text)
            assert after[row.doc_id].n_chars == len(after[row.doc_id].text)


def test_secrets_are_masked(stages):
    after = {r.doc_id: r for r in stages[4].collect()}
    assert len(after) == stages[3].count()
    for row in stages[3].collect():
        if secret_scan.scan(row.text):
            assert not [s for s in secret_scan.scan(after[row.doc_id].text) if s[0] in secret_scan.BASE]
        else:
            assert after[row.doc_id] == row


def test_all_tokens_are_packed(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    ids = {k: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4") for k, t in texts.items()}
    rows = stages[5].collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for row in rows:
        assert row.ids_crc32 == zlib.crc32(ids[row.doc_id][row.start : row.start + row.length].tobytes())


def test_run_and_registry(spark, stages):
    assert registry.queries()["pipeline"] is corpus_pipeline.run
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.agg({"length": "sum"}).collect() == stages[5].agg({"length": "sum"}).collect()


def test_every_operator_is_registered():
    names = [n for n in registry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
