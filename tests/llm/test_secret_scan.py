from __future__ import annotations

import re

from messy import messy_rows

from sparkexp.llm import secret_scan as S

KEY = "AKIA" + "Q7" * 8
OPAQUE = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"


def kinds(text):
    return [k for k, _, _ in S.scan(text)]


def brute_base(text):
    """The contract's patterns, with failing matches dropped after matching."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))


def test_base_spans():
    texts = [
        'token = "0123456789abcdef0123456789abcdef" x',
        "PASSWORD:abcde Secret='abcdef' api_key=zzzzzz APIKEY = q.q-q_q",
        f"{KEY} AKIASHORT AKIAAKIA{KEY} x{KEY}Zq",
        "toſken=abcdef toKen=abcdef é" + "a" * 23 + " " + "b" * 24,
        "passwd= =secret=token=abcdef",
        "",
    ]
    for text in texts:
        assert [x for x in S.scan(text) if x[0] in S.BASE] == brute_base(text)


def test_weak_parts_need_their_complement():
    assert kinds(f"key {OPAQUE} alone") == []
    assert kinds(f"id {KEY} key {OPAQUE}") == ["access", "opaque"]
    assert kinds(f"id {KEY} {'x ' * 200} key {OPAQUE}") == ["access"]
    assert kinds("user: somebody went home") == []
    assert kinds("user: somebody password: hunter22 at https://db.example.com/x") == ["account", "assign", "endpoint"]
    assert kinds("see https://db.example.com/x and password: hunter22") == ["assign"]
    assert kinds("https://db.example.com/x") == []


def test_many_parts_cost_no_pairs():
    text = "user=abc " * 20_000 + "password=abcdef " * 20_000
    assert len(S.scan(text)) >= 20_000


def test_digest_and_redaction(spark, messy, clashing, empty):
    rows = [(100, f"a token={'f' * 30} b"), (101, None), (102, ""), (103, f"id {KEY} {OPAQUE} end"), (103, "clean")]
    docs = messy.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    found = S.digest(docs).collect()
    assert len(found) == len(rows) + len(messy_rows())
    by_id = {r.doc_id: r for r in found}
    assert (by_id[100].n_assign, by_id[100].n_hex, by_id[100].spans) == (1, 1, "assign:2:38,hex:8:38")
    assert by_id[101].spans == "" and by_id[101].base_sha256 == S.base_hash([])
    cleaned = S.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.text for r in cleaned] == ["a [SECRET] b", None, "", "id [SECRET] [SECRET] end", "clean"]
    out = S.redact(clashing)
    assert out.columns == clashing.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, clashing.collect()))
    assert S.digest(empty).count() == 0 and S.redact(empty).count() == 0


def test_opaque_keys_of_any_length_and_after_an_equals_sign():
    long = "aB3+" * 21 + "aB=="
    assert len(long) == 88
    for key in (long, "aB3/" * 5_000, OPAQUE):
        for lead in ("", " ", "'", ":", "=", " = "):
            text = f"id {KEY} aws_secret_access_key{lead or ' '}{key} end"
            start = text.index(key)
            assert S.scan(text)[1:] == [("opaque", start, start + len(key))], (key[:50], lead)
    text = f"account: myacct key {long}"
    assert S.scan(text) == [("account", 0, 15), ("opaque", 20, 108)]
    assert kinds(f"aws_secret_access_key={OPAQUE}") == kinds(long) == []
    assert kinds(f"id {KEY} {OPAQUE}=== x") == ["access"]


def test_long_keys_are_masked(spark):
    text = f"id {KEY} aws_secret_access_key={OPAQUE} or {'aB3+' * 22} end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert S.redact(docs).first().text == "id [SECRET] aws_secret_access_key=[SECRET] or [SECRET] end"
