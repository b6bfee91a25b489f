from __future__ import annotations

import re

import numpy as np
from messy import messy_rows
from sql_check import sql_difference

from sparkexp.llm import quality as Q

SPACE = " \t\n\r\x0b\x0c"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_base_counts():
    texts = [
        None,
        "",
        " \n ",
        "a b c a b c d",
        "a a a a",
        "x\n\nx\n x\nx \n",
        "# é* $%&|<> \x85 \xa0z",
        "a b\x0bc\x0cd\re\tf " * 40,
        "one two three four one two three five two three four",
    ]
    for text in texts:
        words, chars, symbols, lines = Q.base_counts(text)
        assert (len(words), chars, symbols, lines, Q.repeated_words(Q.word_hashes(words))) == brute(text), text


def test_grams_are_counted_over_all_rows(spark, messy):
    rows = messy_rows()
    trusted = spark.createDataFrame([(1,), (5,), (None,), (1,)], "id long")
    corpus, target = Q.count_grams(messy, trusted, "doc_id", "text")

    def grams(texts):
        found = [Q.gram_buckets(Q.word_hashes((t or "").encode().split())) for t in texts]
        return np.bincount(np.concatenate(found), minlength=Q.GRAMS)

    assert (corpus == grams([r[1] for r in rows])).all()
    assert (target == grams([r[1] for r in rows if r[0] in (1, 5)])).all()


def test_the_trusted_sample_is_bounded(spark, messy):
    trusted = spark.createDataFrame([(i,) for i in range(12)], "id long")
    _, some = Q.count_grams(messy, trusted, "doc_id", "text", trusted_documents=2)
    _, every = Q.count_grams(messy, trusted, "doc_id", "text")
    assert 0 < some.sum() < every.sum()


def test_scores_do_not_grow_with_length():
    ratio = np.linspace(-1, 1, Q.GRAMS)
    one = Q.gram_buckets(Q.word_hashes(b"alpha beta gamma delta".split() * 100))
    ten = Q.gram_buckets(Q.word_hashes(b"alpha beta gamma delta".split() * 1000))
    assert abs(ratio[one].mean() - ratio[ten].mean()) < 1e-2


def test_odd_rows(messy, clashing, empty):
    zero = Q.log_ratio(np.zeros(Q.GRAMS), np.zeros(Q.GRAMS))
    assert not zero.any()
    for docs in (messy, clashing):
        rows = Q.judge(docs, zero).collect()
        assert len(rows) == len(messy_rows())
        for row in rows:
            n, chars, symbols, lines, repeats = brute(row.text) if len(row.text or "") < 5000 else (row.n_words, 0, 0, 0, 0)
            assert row.n_words == n
            assert row.base_failed == (n < 50 or 100 * row.n_repeat_words > 50 * n)
            assert row.kept != row.base_failed
    assert Q.judge(empty, zero).count() == 0


def test_query_agrees_with_sql(spark):
    assert sql_difference(spark, "op5_quality_rules") is None
