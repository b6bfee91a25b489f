from __future__ import annotations

import math
from collections import Counter

import pytest
from messy import messy_rows

from sparkexp.llm import ranked_search as R
from sparkexp.llm.rows import words_of
from sql_check import sql_difference

ITEMS = "item_id long, text string"


def expected(docs, items, top=10):
    """Every document is scored for every item."""
    counted = [(doc_id, Counter(words_of(text))) for doc_id, text in docs if words_of(text)]
    n_docs, terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, counts in counted:
            m, score = 25 + (75 * counts.total() * n_docs) // terms, 0
            for term, times in Counter(words_of(text)).items():
                tf = counts.get(term, 0)
                if tf:
                    score += times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda s: s[:3])
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


def rows_of(found):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()], key=repr)


def items_of(docs):
    texts = [t for _, t in docs if t]
    cut = [" ".join(t.split()[3:30]) for t in texts[:12]]
    odd = [None, "", "...", "never seen", "ba ba ba ke", cut[1].upper(), texts[2][:3000], "é x"]
    return [(i, t) for i, t in enumerate([*cut, *odd])] + [(1, cut[1]), (1, cut[1]), (None, cut[3]), (None, "ba")]


@pytest.mark.parametrize(
    "sizes",
    [
        {},
        {"owners": 1},
        {"owners": 3, "bundle_size": 3, "block_docs": 4},
        {"owners": 2, "bundle_size": 5, "block_postings": 60, "broadcast_bytes": 0, "top": 3},
    ],
)
def test_agrees_with_scoring_every_document(spark, messy, sizes):
    docs = [(r[0], r[1]) for r in messy_rows()]
    items = items_of(docs)
    found = R.search(messy, spark.createDataFrame(items, ITEMS), **sizes)
    assert rows_of(found) == expected(docs, items, sizes.get("top", 10))


def test_ties_copies_and_a_term_in_a_third_of_all_documents(spark):
    docs = [(i, ("hot word " if i % 3 == 0 else "other ") + f"w{i % 7} " * (i % 5)) for i in range(300)] + [(5, "hot word ")] * 40
    items = [(1, "hot"), (2, "w1 w2 w3 hot"), (3, "other w6 w6")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for sizes in ({"block_docs": 16}, {"block_docs": 1000, "owners": 2}):
        assert rows_of(R.search(table, spark.createDataFrame(items, ITEMS), **sizes)) == expected(docs, items)


def test_empty_tables_and_clashing_columns(spark, messy, clashing, empty):
    items = spark.createDataFrame([(1, "ba ke li")], "item_id long, text string").selectExpr("*", "1 AS bundle", "'x' AS terms")
    assert R.search(empty, items).count() == 0 and R.search(messy, items.limit(0)).count() == 0
    assert R.search(messy.where("text IS NULL"), items).count() == 0
    odd = clashing.selectExpr("*", "'own' AS rank", "'own' AS item_id", "'own' AS block", "'own' AS term")
    out = R.search(odd, items)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and rows_of(out) == rows_of(R.search(messy, items))


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "abc déf  x1 " * 50 + "tail"
    whole = R.count_terms(text)
    monkeypatch.setattr(R, "_TEXT_AT_ONCE", 7)
    assert R.count_terms(text) == whole


def test_owners_share_the_postings():
    weights = [(w, 10) for w in range(100)]
    limits = R.owner_limits(weights, 4)
    shares = Counter(sum(w <= limit for limit in limits) for w, _ in weights)
    assert limits == sorted(limits, reverse=True) and set(shares) == {0, 1, 2, 3} and max(shares.values()) <= 26
    assert R.owner_limits([(5, 1)], 3) == [-1, -1] and R.owner_limits([], 2) == [-1]


def test_query_agrees_with_sql(spark):
    assert sql_difference(spark, "op12_ranked_search") is None
