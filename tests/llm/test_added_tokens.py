"""Texts with the content of an added token, against the library's own encoding."""

from __future__ import annotations

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from messy import DOCS, messy_rows
from tokenizers import AddedToken, Tokenizer

from sparkexp.llm import queries
from sparkexp.llm.tokens import TextEncoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)
TEXTS = [
    "a <|endoftext|> b",
    "<|endoftext|>",
    "x<|endoftext|><|endoftext|>.",
    "a<|endoftext|>\nb c",
    "<|endoftext| > no",
    " <|endoftext|>  b\t",
    "\n<|endoftext|>\n",
]


def ids_of(text, tokenizer=TOKENIZER):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()


@pytest.mark.parametrize("kept", [3, 100_000])
def test_added_tokens_get_their_ids(kept):
    assert list(np.frombuffer(ids_of("a <|endoftext|> b"), "<u4")) == [64, 220, 50256, 275, 0]
    texts = TEXTS + [r[1] for r in messy_rows()]
    own = TextEncoder(VOCABULARY, bytes_kept=kept, added_tokens=True)
    for _ in range(2):
        assert own.encode(texts) == [ids_of(t) for t in texts]


@pytest.mark.parametrize("added_tokens", [False, True])
def test_tokens_that_are_added_but_not_special(tmp_path, added_tokens):
    path = str(tmp_path / "more.json")
    more = Tokenizer.from_file(VOCABULARY)
    more.add_tokens([AddedToken("two words", normalized=False)])
    more.save(path)
    more.encode_special_tokens = not added_tokens
    texts = ["say two words now", "x two wordsy", *TEXTS]
    assert TextEncoder(path, added_tokens=added_tokens).encode(texts) == [ids_of(t, more) for t in texts]


def test_queries_and_pipeline_encode_as_the_library(spark, tmp_path):
    rows = [(i, t, "xx", "s", len(t)) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    wanted = [(i, len(ids_of(t)) // 4, zlib.crc32(ids_of(t))) for i, t in enumerate(TEXTS)]
    found = queries.op7_token_records(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in found] == wanted
    assert [r.start for r in found] == np.cumsum([0, *(n for _, n, _ in wanted[:-1])]).tolist()
    packed = corpus_pipeline.pack_sequences(spark, docs, str(tmp_path))
    for table in (queries.op6_packing(spark, str(tmp_path)), packed):
        assert sorted((r.doc_id, r.doc_tokens, r.ids_crc32) for r in table.collect()) == wanted
