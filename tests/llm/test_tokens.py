"""Encoding, record files and packing against whole-text encoding."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from messy import messy_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkexp.llm import packing, token_records
from sparkexp.llm.crc32c import crc32c, masked
from sparkexp.llm.tokens import TextEncoder
from sparkexp.sources.scratch import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)
TOKENIZER.encode_special_tokens = True


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()


ODD = [
    None,
    "",
    " ",
    "\n",
    " a",
    "a ",
    "a  b",
    "a\n\nb",
    "a \n b",
    "a\tb c",
    "a\t b",
    "a  b   c",
    "it's we'll 12 ab12 !? x\r\ny",
    "<|endoftext|> é ǘ 漢字 😀 a\x1cb \x1cc",
    "x\x85 y z w\n1",
]


@pytest.mark.parametrize("kept", [3, 100_000])
def test_cut_texts_encode_as_whole_ones(kept):
    texts = ODD + [r[1] for r in messy_rows()]
    own = TextEncoder(VOCABULARY, bytes_kept=kept)
    for _ in range(2):
        assert own.encode(texts) == [ids_of(t) for t in texts]


def test_each_distinct_piece_is_looked_up_once_for_many_texts():
    own, asked = TextEncoder(VOCABULARY), []
    make = own.known.make
    own.known.make = lambda piece: asked.append(piece) or make(piece)
    texts = [f"same{i % 7} words, here. and\nthere?! only{'abc'[i % 3]})" for i in range(4_000)] + ODD
    batches = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    found = list(own.encode_rows(batches.slice(k, 50) for k in range(0, len(texts), 50)))
    assert [n for names, _ in found for n in names] == list(range(len(texts)))
    assert [raw for _, ids in found for raw in ids] == [ids_of(t) for t in texts]
    assert len(found) == 1 and len(asked) == len(set(asked)) < 60
    # A word with punctuation after it is not remembered beside the word.
    assert "words" in own.known and "words," not in own.known
    few = TextEncoder(VOCABULARY, bytes_kept=800)
    assert [raw for _, ids in few.encode_rows([batches]) for raw in ids] == [ids_of(t) for t in texts]


def test_texts_of_the_test_tables_encode_as_whole_ones(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    assert TextEncoder(VOCABULARY).encode(texts) == [ids_of(t) for t in texts]


def test_checksums():
    assert crc32c([b"123456789"])[0] == 0xE3069283  # the published check value
    assert crc32c([bytes(32), b"\xff" * 32, bytes(range(32))]).tolist() == [0x8A9136AA, 0x62A8AB43, 0x46DD794E]

    def plain(data):
        state = 0xFFFFFFFF
        for byte in data:
            state ^= byte
            for _ in range(8):
                state = state >> 1 ^ (0x82F63B78 if state & 1 else 0)
        return state ^ 0xFFFFFFFF

    rng = np.random.default_rng(1)
    parts = [rng.bytes(n) for n in (4, 5, 127, 128, 129, 1000, 256, 4)]
    assert crc32c(parts).tolist() == [plain(p) for p in parts]
    assert masked(np.array([0xE3069283], np.uint32))[0] == ((0xE3069283 >> 15 | 0xE3069283 << 17) + 0xA282EAD8) % (1 << 32)


def test_frames_round_trip_and_damage_is_found():
    ids = [ids_of(t) for t in ODD]
    names = [None, -5, 2**62, *range(len(ODD) - 3)]
    for wide in (False, True):
        made = token_records.frames(names, ids, wide)
        assert token_records.parse(made) == list(zip(names, ids))
        for at in (0, 9, 14, len(made[-1]) - 1):
            bad = bytearray(made[-1])
            bad[at] ^= 1
            with pytest.raises(ValueError):
                token_records.parse([bytes(bad)])


@pytest.mark.parametrize("table", ["messy", "clashing"])
def test_records(spark, table, request):
    docs = request.getfixturevalue(table)
    folder = scratch_path(spark, "records")
    index = token_records.write_records(docs, folder, VOCABULARY, file_bytes=20_000)
    files = token_records.number_of_files(spark, index)
    assert files > 3
    found = token_records.digest(token_records.read_records(index, folder, files), index).orderBy("start").collect()
    wanted = Counter((r[0], len(ids_of(r[1])) // 4, zlib.crc32(ids_of(r[1]))) for r in messy_rows())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == wanted
    names = [r.doc_id for r in found]
    assert names == sorted(names, key=lambda n: (n is not None, n))
    at = 0
    for row in found:
        assert row.start == at
        at += row.n_tokens
    some = index.where(F.col("offset") > 0).orderBy(F.rand(1)).limit(7)
    assert token_records.read_records(some, folder, 2).count() == 7


def test_records_of_an_empty_table(spark, empty):
    folder = scratch_path(spark, "records")
    index = token_records.write_records(empty, folder, VOCABULARY)
    assert index.count() == 0
    files = token_records.number_of_files(spark, index)
    assert token_records.digest(token_records.read_records(index, folder, files), index).count() == 0


def test_packer_keeps_few_windows_open():
    rng = np.random.default_rng(2)
    packer, closed = packing.Packer(100, 4), []
    for i, length in enumerate(rng.integers(1, 101, 2000).tolist()):
        closed += packer.place(length, (i, length))
        assert len(packer.open) <= 4
    closed += packer.rest()
    assert sorted(i for _, pieces in closed for i, _ in pieces) == list(range(2000))
    assert max(sum(n for _, n in pieces) for _, pieces in closed) <= 100


def test_packer_places_best_and_emits_the_fullest():
    packer = packing.Packer(10, 2)
    assert packer.place(4, "a") == [] and packer.place(7, "b") == []
    assert packer.place(3, "c") == [(1, ["b", "c"])]  # exactly full
    assert packer.place(8, "d") == []
    assert packer.place(9, "e") == [(2, ["d"])]


@pytest.mark.parametrize("table", ["messy", "clashing"])
def test_packing(table, request):
    docs = request.getfixturevalue(table)
    rows = packing.pack(docs, VOCABULARY, merged_partitions=2).collect()
    wanted = Counter((r[0], ids_of(r[1])) for r in messy_rows())
    by_sequence, pieces = defaultdict(list), defaultdict(list)
    for row in rows:
        assert len(row.ids) == 4 * row.length > 0
        by_sequence[row.sequence_id].append((row.offset, row.length))
        pieces[row.doc_id, row.doc_tokens, row.start].append(row.ids)
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    for (name, whole, start), found in pieces.items():
        possible = [ids for (n, ids), k in wanted.items() for _ in range(k) if n == name and len(ids) == 4 * whole]
        assert sorted(found) == sorted(ids[4 * start : 4 * start + len(found[0])] for ids in possible)
    assert sum(r.length for r in rows) == sum(len(ids) // 4 * k for (_, ids), k in wanted.items())


def test_packing_of_the_test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.digest(packing.pack(docs, VOCABULARY)).collect()
    texts = {r.doc_id: ids_of(r.text) for r in docs.select("doc_id", "text").collect()}
    for row in rows:
        assert row.ids_crc32 == zlib.crc32(texts[row.doc_id][4 * row.start : 4 * (row.start + row.length)])
        assert row.doc_tokens == len(texts[row.doc_id]) // 4
    total = sum(r.length for r in rows)
    assert total == sum(len(t) // 4 for t in texts.values())
    assert total / (1024 * len({r.sequence_id for r in rows})) > 0.97


def test_packing_of_an_empty_table(empty):
    assert packing.pack(empty, VOCABULARY).count() == 0


def test_checksums_without_the_ids_are_those_of_the_ids(spark, messy):
    folder = scratch_path(spark, "records")
    index = token_records.write_records(messy, folder, VOCABULARY)
    files = token_records.number_of_files(spark, index)
    with_ids, without = (token_records.digest(token_records.read_records(index, folder, files, with_ids=w), index) for w in (True, False))
    assert sorted(with_ids.collect(), key=repr) == sorted(without.collect(), key=repr)
