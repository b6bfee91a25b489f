from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from messy import DOCS, messy_rows, words
from sql_check import sql_difference

from sparkexp.llm import ngram_join as J
from sparkexp.llm.components import connected_components


def groups(rows):
    """The group of each row and its number of links, by comparing all pairs."""
    sets = [set(J.shingles(r[1]).tolist()) for r in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 10 * len(a & b) >= 8 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], links


def brute(rows):
    group, links = groups(rows)
    names = defaultdict(list)
    for g, row in zip(group, rows):
        names[g].append(row[0])
    least = {g: min((n for n in v if n is not None), default=None) for g, v in names.items()}
    return sorted(repr((r[0], least[g], n)) for r, g, n in zip(rows, group, links))


def answer(docs):
    return sorted(repr((r.doc_id, r.class_id, r.n_links)) for r in J.near_duplicates(docs).collect())


@pytest.mark.parametrize("table", ["messy", "clashing"])
def test_odd_rows(table, request):
    assert answer(request.getfixturevalue(table)) == brute(messy_rows())


def near_copies():
    """A group of near copies with a third of the rows, chains, and texts that share a long first line."""
    rng = random.Random(3)
    line, base, rows = words(rng, 30), words(rng, 150), []
    for _ in range(120):
        copy = list(base)
        for _ in range(rng.randint(0, 7)):
            copy[rng.randrange(len(copy))] = words(rng, 1)[0]
        rows.append(" ".join(copy))
    chain = words(rng, 120)
    for _ in range(25):
        chain = list(chain)
        chain[rng.randrange(len(chain))] = words(rng, 1)[0]
        rows.append(" ".join(chain))
    rows += [" ".join(line + words(rng, rng.randint(1, 60))) for _ in range(120)]
    rows += [" ".join(words(rng, rng.randint(1, 80))) for _ in range(80)]
    rows += rows[:30]
    return [(i, t, None, None, None) for i, t in enumerate(rng.sample(rows, len(rows)))]


@pytest.mark.parametrize("block", [(2_000, 1_000_000), (25, 3_000)])
def test_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK_CLASSES", block[0])
    monkeypatch.setattr(J, "BLOCK_SHINGLES", block[1])
    rows = near_copies()
    assert answer(spark.createDataFrame(rows, DOCS).repartition(4)) == brute(rows)


def test_one_of_each_group_stays(messy, clashing, empty):
    rows = messy_rows()
    group, _ = groups(rows)
    least = {}
    for g, row in zip(group, rows):
        least[g] = min(least.get(g, (True, 0)), (row[0] is None, row[0] or 0))
    for docs in (messy, clashing):
        kept = J.keep_one(docs)
        assert kept.columns == docs.columns
        found = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
        assert found == sorted(least.values())
        assert {(r.doc_id, r.text) for r in kept.collect()} <= {(r[0], r[1]) for r in rows}
        assert J.near_duplicates(kept).where("n_links > 0").count() == 0
    assert J.keep_one(empty).count() == 0 and J.near_duplicates(empty).count() == 0


def test_pruning_keeps_similar_pairs_and_drops_others():
    rng = np.random.default_rng(4)
    limits = dict(J.least_matches())
    assert list(limits) == list(range(J.STEP, J.VALUES + 1, J.STEP))
    assert all(a <= b for a, b in zip(list(limits.values()), list(limits.values())[1:]))
    one = rng.integers(0, 1 << 16, J.VALUES)
    near, far = one.copy(), one.copy()
    near[rng.random(J.VALUES) > 0.8] ^= 1
    far[rng.random(J.VALUES) > 0.3] ^= 1
    found = list(J.surviving_pairs(one[None].astype("<u2"), np.stack([near, far]).astype("<u2"), False))
    assert [(i, rows.tolist()) for i, rows in found] == [(0, [0])]


def test_minhash_estimates_the_similarity():
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    b = np.concatenate([a[:2700], rng.integers(0, 1 << 63, 300, dtype=np.uint64)])
    equal = (J.minhash(a) == J.minhash(b)).mean()
    assert abs(equal - 2700 / 3300) < 0.12


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(200, 260)] + [(0, i) for i in range(1, 80)] + [(rng.randrange(100, 150), rng.randrange(100, 150)) for _ in range(30)]
    edges += [(5, 5), (None, 3)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert found == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_agrees_with_sql(spark):
    assert sql_difference(spark, "op1_ngram_join") is None
