from __future__ import annotations

import random
import re

import pytest
from messy import messy_rows
from sql_check import sql_difference

from sparkexp.llm.decontaminate import ItemAutomaton, decontaminate, digest, find_spans, items_hash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    doc, hit, names = read(text), set(), set()
    for name, item in items:
        own = read(item)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            for at in range(len(doc) - size + 1):
                if doc[at : at + size] == own[i : i + size]:
                    hit.update(range(at, at + size))
                    names.add(name)
    return len(doc), len(hit), sorted(names)


@pytest.mark.parametrize("seed", range(30))
def test_automaton_agrees_with_brute_force(seed):
    rng = random.Random(seed)
    alphabet = "ab cd Ef"[: rng.choice([5, 8])].split()
    items = [(str(i), " ".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))) for i in range(6)]
    automaton = ItemAutomaton(items, window=4)
    for _ in range(30):
        text = " ".join(rng.choice([*alphabet, "zz"]) for _ in range(rng.randint(0, 30)))
        spans, names = automaton.scan([w.encode() for w in read(text)])
        assert (len(read(text)), sum(b - a for a, b in spans), sorted(names)) == brute(text, items, window=4)


def item_rows():
    texts = [r[1] for r in messy_rows()]
    return [
        (1, " ".join(texts[0].split()[2:30])),
        (2, " ".join(texts[3].split()[:11]).upper()),
        (3, "a B"),
        (4, None),
        (5, ""),
        (None, " ".join(texts[5].split()[4:16])),
        (1, "one"),
        (3, "a B"),
    ]


@pytest.mark.parametrize("block_bytes", [4_000_000, 60])
def test_digest(spark, messy, block_bytes):
    items = spark.createDataFrame(item_rows(), "item_id long, text string")
    found = digest(find_spans(messy, items, keep=["doc_id"], block_bytes=block_bytes)).collect()
    pairs = [("" if i is None else str(i), t) for i, t in item_rows()]
    wanted = []
    for row in messy_rows():
        n_words, n_hit, names = brute(row[1], pairs)
        wanted.append((row[0], n_words, n_hit, len(names), items_hash(names), n_hit > 0))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))


def test_spans_go_and_clean_documents_stay(spark, messy, clashing):
    rows = messy_rows()
    item = " ".join(rows[0][1].split()[2:30])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    for docs in (messy, clashing):
        kept = decontaminate(docs, items, max_coverage=0.9)
        assert kept.columns == docs.columns
        found = {r.doc_id: r for r in kept.collect() if r.doc_id is not None}
        assert found[0].text.split() == rows[0][1].split()[:2] + rows[0][1].split()[30:]
        assert found[0].n_chars == len(found[0].text)
        assert all(found[i].text == rows[i][1] for i in range(1, 12) if i != 5)
        assert kept.count() == len(rows)
    covered = decontaminate(messy, items, max_coverage=0.01)
    assert covered.count() == len(rows) - 2  # the text and its near copy


def test_capitals_and_punctuation_around_a_span(spark):
    item = "alpha Beta gamma delta epsilon zeta Eta theta iota KAPPA lambda"
    rows = [
        (1, f"ONE, Two! {item.upper()}. THREE Four", None, None, 9),
        (2, f"É É' X-Y (\n{item}) Z", None, None, 9),
        (3, "ALL Capitals, AND Nothing Else HERE", None, None, 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r.doc_id: (r.text, r.n_chars) for r in decontaminate(docs, items, max_coverage=0.9).collect()}
    assert found == {1: ("ONE, Two! . THREE Four", 22), 2: ("É É' X-Y (\n) Z", 14), 3: (rows[2][1], 9)}


def test_empty_tables(spark, messy, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert digest(find_spans(empty, none)).count() == 0
    assert digest(find_spans(messy, none)).where("contaminated").count() == 0
    assert decontaminate(messy, none).count() == messy.count()


def test_query_agrees_with_sql(spark):
    assert sql_difference(spark, "op8_decontaminate") is None
