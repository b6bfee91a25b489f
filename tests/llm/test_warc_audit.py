from __future__ import annotations

import gzip
import hashlib
import zlib
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from sql_check import SF_DIR

from sparkexp.llm import queries, warc_audit as W
from sparkexp.sources.scratch import scratch_path

ROWS = [(i, f"http://x/{i}", f"<p>{i}</p>" * (i % 7 + 1)) for i in range(300)]
ROWS += [(None, None, None), (5, "", ""), (5, "", ""), (6, "a\r\nb", "é" * 5000)]
PAGES = "page_id long, url string, html string"


@pytest.fixture
def replicas(spark):
    pages = spark.createDataFrame(ROWS, PAGES).repartition(3)
    root = scratch_path(spark, "warc")
    index = W.write_warc(pages, f"{root}/one", file_bytes=4_000)
    return index, root


def local(root, file):
    return f"{urlparse(root).path}/{file}"


def test_stored_records_are_whole_warc_records(replicas):
    index, root = replicas
    rows = index.collect()
    assert len(rows) == len(ROWS) and len({r.file for r in rows}) > 3
    for row in rows:
        with open(local(f"{root}/one/data", row.file), "rb") as source:
            source.seek(row.offset)
            text = gzip.decompress(source.read(row.length)).decode()
        head, _, body = text.partition("\r\n\r\n")
        assert head.startswith("WARC/1.1\r\n") and body.endswith("\r\n\r\n")
        assert f"Content-Length: {len(body[:-4].encode())}" in head
        same = [r for r in ROWS if r[0] == row.page_id]
        assert body[:-4] in {r[2] or "" for r in same}


@pytest.mark.parametrize("fan", [2, 16])
def test_only_damaged_records_are_found(spark, replicas, fan):
    index, root = replicas
    damaged = F.pmod("page_id", F.lit(37)) == 4
    W.copy_replica(index, f"{root}/one", f"{root}/other", damaged)
    found = W.audit(index, f"{root}/one", f"{root}/other", fan).collect()
    assert len(found) == len(ROWS)
    assert {r.page_id for r in found if r.damaged} == {i for i in range(300) if i % 37 == 4}
    for row in found[:40]:
        with open(local(f"{root}/one/data", row.file), "rb") as source:
            source.seek(row.offset)
            assert row.record_sha256 == hashlib.sha256(source.read(row.length)).hexdigest()
    same = W.audit(index, f"{root}/one", f"{root}/one", fan)
    assert same.where("damaged").count() == 0


def test_lost_and_short_files(spark, replicas):
    index, root = replicas
    W.copy_replica(index, f"{root}/one", f"{root}/other", F.lit(False))
    rows = index.collect()
    files = sorted({r.file for r in rows})
    store, top = W._store(f"{root}/other/data")
    store.delete_file(f"{top}/{files[0]}")
    last = max((r for r in rows if r.file == files[1]), key=lambda r: r.offset)
    with open(local(f"{root}/other/data", files[1]), "r+b") as cut:
        cut.truncate(last.offset + 1)
    found = {(r.file, r.position) for r in W.audit(index, f"{root}/one", f"{root}/other").where("damaged").collect()}
    assert found == {(r.file, r.position) for r in rows if r.file == files[0]} | {(last.file, last.position)}


def test_appended_bytes_and_stray_files(replicas):
    index, root = replicas
    W.copy_replica(index, f"{root}/one", f"{root}/other", F.lit(False))
    files = sorted({r.file for r in index.collect()})
    with open(local(f"{root}/other/data", files[2]), "ab") as more:
        more.write(b"x" * 1000)
    with open(local(f"{root}/other/data", "stray.warc.gz"), "wb") as stray:
        stray.write(b"12345")
    found = W.audit(index, f"{root}/one", f"{root}/other").collect()
    assert not any(r.damaged for r in found)
    assert {r.file for r in found if r.end_differs} == {files[2]} and len(found) == len(ROWS)
    assert [tuple(r) for r in W.stray_files(index, f"{root}/other").collect()] == [("stray.warc.gz", 5)]
    assert W.stray_files(index, f"{root}/one").count() == 0


def test_a_plan_holds_one_level(spark):
    def plan(count):
        trees = []
        for name in "ab":
            rows = [("f", i, i, i + 1, f"{name if i == 3 else 'same'}") for i in range(count)]
            trees.append(W.build_tree(spark.createDataFrame(rows, W._LEAVES), fan=2))
        found = W.differing_records(*trees, fan=2)
        assert [tuple(r) for r in found.collect()] == [("f", 3)]
        return len(found._jdf.queryExecution().optimizedPlan().toString().splitlines())

    assert plan(4) == plan(64)


def test_trees_of_unequal_height(spark):
    def tree(hashes):
        rows = [("f", i, i * 10, i * 10 + 10, h) for i, h in enumerate(hashes)] + [("g", 0, 0, 9, "same")]
        return W.build_tree(spark.createDataFrame(rows, W._LEAVES), fan=2)

    found = W.differing_records(tree("abcdefghi"), tree("abXd"), fan=2)
    assert {(r.file, r.position) for r in found.collect()} == {("f", i) for i in (2, 4, 5, 6, 7, 8)}


def test_query_finds_the_damage(spark):
    rows = queries.op2_warc_audit(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/pages.parquet").count()
    assert all(r.damaged == (zlib.crc32(str(r.page_id).encode()) % 100 == 7) for r in rows)


def test_empty_table(spark):
    root = scratch_path(spark, "warc")
    index = W.write_warc(spark.createDataFrame([], PAGES), f"{root}/one")
    W.copy_replica(index, f"{root}/one", f"{root}/other", F.lit(True))
    assert W.audit(index, f"{root}/one", f"{root}/other").count() == 0
