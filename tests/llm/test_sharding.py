from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from messy import DOCS, messy_rows
from pyspark.sql import functions as F

from sparkexp.llm import sharding as S


def rows_of(found):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in found)


def check(found, rows, shards):
    assert rows_of(found) == Counter(rows)
    slots = defaultdict(list)
    for row in found:
        slots[row.shard].append(row.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_fisher_yates_is_a_fair_permutation():
    seen = Counter(tuple(S.fisher_yates(3, [seed])) for seed in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    for n in (0, 1, 2, 50):
        assert sorted(S.fisher_yates(n, [1])) == list(range(n))


@pytest.mark.parametrize("bucket_bytes", [3_000, 10**9])
def test_shards(messy, bucket_bytes):
    check(S.shuffle_into_shards(messy, shards=5, bucket_bytes=bucket_bytes).collect(), messy_rows(), 5)


def test_order_depends_on_the_seed_alone(messy):
    def order(docs, seed=7):
        found = S.shuffle_into_shards(docs, shards=3, seed=seed, bucket_bytes=3_000).collect()
        return [(r.doc_id, r.text, r.shard, r.slot) for r in sorted(found, key=lambda r: (r.shard, r.slot))]

    assert order(messy) == order(messy.repartition(7)) == order(messy.coalesce(1)) != order(messy, seed=8)


def test_a_key_with_a_third_of_the_rows_is_spread(spark):
    rows = [(7 if i % 3 == 0 else i, f"text {i} " * 20, None, None, i) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    found = S.shuffle_into_shards(docs, shards=40, bucket_bytes=10_000).collect()
    check(found, rows, 40)
    hot = np.bincount([r.shard for r in found if r.doc_id == 7], minlength=40)
    assert hot.max() < 60  # 25 a shard on average


def test_digest_and_clashing_columns(clashing, empty):
    out = S.shuffle_into_shards(clashing, shards=3)
    assert Counter(out.columns) == Counter([*clashing.columns])
    digest = S.digest(out).collect()
    wanted = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in messy_rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in digest) == wanted
    assert {r.law for r in digest} == {"rows"} and {r.grown_shard for r in digest} == {None}
    assert S.digest(S.shuffle_into_shards(empty)).count() == 0


@pytest.mark.parametrize("shape", ["repartition", "join", "aggregate", "sorted"])
def test_no_row_is_lost_whatever_the_input_is(spark, shape):
    """A third of the rows are equal in every column, another third share a key."""
    rows = [(7, "same text " * 9, None, "s", 1) if i % 3 == 0 else (8 if i % 3 == 1 else i, f"text {i} " * 20, None, None, i) for i in range(4000)]
    docs = spark.createDataFrame(rows, DOCS)
    if shape == "repartition":
        docs = docs.repartition(5)
    elif shape == "join":
        docs = docs.repartition(3).join(spark.range(4001).selectExpr("id AS doc_id"), "doc_id")
    elif shape == "aggregate":
        counted = docs.groupBy(*docs.columns).count()
        docs = counted.selectExpr(*docs.columns, "explode(sequence(1L, count)) AS copy").drop("copy")
    else:
        docs = docs.orderBy("n_chars")
    found = S.shuffle_into_shards(docs, shards=40, bucket_bytes=10_000).collect()
    check(found, rows, 40)
    same = np.bincount([r.shard for r in found if r.doc_id == 7], minlength=40)
    assert same.max() < 70  # 33 a shard on average
    again = S.shuffle_into_shards(spark.createDataFrame(rows, DOCS).repartition(2), shards=40, bucket_bytes=10_000).collect()
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in again) == Counter((r.doc_id, r.text, r.shard, r.slot) for r in found)


def test_an_input_that_changes_from_run_to_run_raises(spark):
    changing = F.udf(lambda number: f"{random.random()} {number}").asNondeterministic()
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), changing("id").alias("text"))
    with pytest.raises(Exception, match="Store it first"):
        S.shuffle_into_shards(docs, bucket_bytes=5_000)


def test_columns_of_any_type(spark):
    docs = spark.createDataFrame([(i % 3, "t", {"a": 1}, [1, 2], None) for i in range(90)], "doc_id long, text string, m map<string,int>, l array<int>, d double")
    found = S.shuffle_into_shards(docs, shards=4, bucket_bytes=100).collect()
    assert Counter((r.doc_id, r.m["a"], tuple(r.l)) for r in found) == {(k, 1, (1, 2)): 30 for k in range(3)}
