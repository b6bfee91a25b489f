"""Fixity audit of WARC replicas with Merkle trees.

Pages are stored as WARC files, each record a gzip member of its own, with an index
of offsets. For an audit every record's stored bytes are hashed; ``FAN`` neighbours
in offset order make a node whose hash covers theirs and their offset range, and
so on up to one root a file. Two replicas are compared root by root, and only the
children of nodes that differ are looked at, down to the damaged records.

Hashing reads records where their offsets say, so a flipped byte, a truncated file,
a lost file and shifted data are all found. The last leaf of a file covers what stands behind its last
record, so appended bytes are found too; ``stray_files`` lists files that the index does not name.
The trees are written level by level to the shared folder; a level is a FAN-th of the one below.
On the way down, the nodes that differ are written as well, and the descent ends where there are none.

Defined results: null url or html are stored as empty, and marked as null in the
record's headers. A null page id has an empty record id. Repeated rows are records of
their own. An empty table has no files and no findings. A file that is missing or
short hashes as the bytes that are there.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sparkexp.llm.rows import position_of
from sparkexp.sources.scratch import discard, materialize, scratch_path

FAN = 16
FILE_BYTES = 256_000_000
_AT_ONCE = 256
_REST_AT_ONCE = 4_000_000

_INDEX = StructType(
    [
        StructField("page_id", LongType()),
        StructField("file", StringType()),
        StructField("position", LongType()),
        StructField("offset", LongType()),
        StructField("length", LongType()),
    ]
)
_LEAVES = StructType(
    [
        StructField("file", StringType()),
        StructField("node", LongType()),
        StructField("first", LongType()),
        StructField("end", LongType()),
        StructField("hash", StringType()),
    ]
)


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """A WARC resource record as a gzip member."""
    body = (html or "").encode("utf-8", "surrogatepass")
    nulls = ",".join(n for n, v in (("url", url), ("html", html)) if v is None)
    name = "" if page_id is None else str(page_id)
    head = (
        f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{name}>\r\n"
        f"WARC-Target-URI: {' '.join((url or '').split())}\r\nX-Null: {nulls}\r\nContent-Length: {len(body)}\r\n\r\n"
    )
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n") + packer.flush()


def write_warc(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write the pages as WARC files, each partition its own, and return the written index.

    No shuffle. Files have a new name for every attempt of a task and count only
    when the index names them.
    """
    three = pages.toDF(*[f"_{i}" for i in range(len(pages.columns))]).select(
        F.col(f"_{position_of(pages, page_id)}").cast("long"),
        *[F.col(f"_{position_of(pages, c)}").cast("string") for c in (url, html)],
    )
    arrow = to_arrow_schema(_INDEX)
    data = f"{folder}/data"
    store, root = _store(data)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, top = _store(data)
        name, out, at, position = "", None, 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, _AT_ONCE):
                part, rows = batch.slice(start, _AT_ONCE), []
                for values in zip(*(c.to_pylist() for c in part.columns)):
                    if out is None or at >= file_bytes:
                        if out:
                            out.close()
                        name, at, position = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = place.open_output_stream(f"{top}/{name}", compression=None)
                    made = record(*values)
                    out.write(made)
                    rows.append((values[0], name, position, at, len(made)))
                    at, position = at + len(made), position + 1
                columns = [pa.array(list(v), f.type) for v, f in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        if out:
            out.close()

    three.mapInArrow(write, _INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(_INDEX).parquet(f"{folder}/index")


class _Reader:
    """Reads ranges of files; what is not there is empty."""

    def __init__(self, folder: str) -> None:
        self.store, self.root = _store(folder)
        self.name, self.source, self.size = None, None, 0

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.source:
                self.source.close()
            info = self.store.get_file_info(f"{self.root}/{name}")
            found = info.type == fs.FileType.File
            self.name, self.size = name, info.size if found else 0
            self.source = self.store.open_input_file(f"{self.root}/{name}") if found else None
        if self.source is None or offset >= self.size:
            return b""
        self.source.seek(offset)
        return self.source.read(min(length, self.size - offset))


    def rest(self, name: str, offset: int) -> tuple[int, str]:
        """Where the file ends, and the hash of what stands from ``offset`` on."""
        found = hashlib.sha256()
        while part := self.read(name, offset, _REST_AT_ONCE):
            found.update(part)
            offset += len(part)
        return offset, found.hexdigest()


def _by_file(index: DataFrame, *more: Column) -> DataFrame:
    """Index rows dealt by file, in offset order."""
    files = index.select("file").distinct().count()
    rows = index.select("file", "position", "offset", "length", *more)
    return rows.repartition(max(1, files), "file").sortWithinPartitions("file", "offset")


def copy_replica(index: DataFrame, source: str, target: str, damaged: Column) -> None:
    """Copy all files of a replica; in records where ``damaged`` holds one byte is flipped.

    This makes replicas for tests and demonstrations; an audit only reads.
    """
    store, root = _store(f"{target}/data")
    store.create_dir(root, recursive=True)
    schema = StructType([StructField("file", StringType())])
    arrow = to_arrow_schema(schema)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, (place, top) = _Reader(f"{source}/data"), _store(f"{target}/data")
        name, out, part = None, None, ""
        for batch in batches:
            done = []
            for file, position, offset, length, flip in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    if out:
                        out.close()
                        place.move(part, f"{top}/{name}")
                        done.append(name)
                    name, part = file, f"{top}/.{uuid.uuid4().hex}"
                    out = place.open_output_stream(part, compression=None)
                made = bytearray(reader.read(file, offset, length))
                if flip and made:
                    made[(position * 7919) % len(made)] ^= 1
                out.write(bytes(made))
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], schema=arrow)
        if out:
            out.close()
            place.move(part, f"{top}/{name}")

    # Counting makes all tasks run; moving a finished file over its equal is harmless when a task runs again.
    _by_file(index, F.coalesce(damaged, F.lit(False)).alias("flip")).mapInArrow(copy, schema).count()


def leaves(index: DataFrame, folder: str) -> DataFrame:
    """The hash of each record's bytes as this replica stores them, and of what follows a file's last record."""
    data, arrow = f"{folder}/data", to_arrow_schema(_LEAVES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, last = _Reader(data), None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(list(v), f.type) for v, f in zip(zip(*rows), arrow)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        def tail() -> tuple:
            """The leaf for what stands behind the last record of a file."""
            file, position, _, end, _ = last
            return (file, position + 1, end, *reader.rest(file, end))

        for batch in batches:
            rows = []
            for file, position, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if last and last[0] != file:
                    rows.append(tail())
                found = hashlib.sha256(reader.read(file, offset, length)).hexdigest()
                last = (file, position, offset, offset + length, found)
                rows.append(last)
            if rows:
                yield batch_of(rows)
        if last:
            yield batch_of([tail()])

    return _by_file(index).mapInArrow(run, _LEAVES)


@dataclass(frozen=True)
class Tree:
    """The written levels of all files' trees, leaves first."""

    levels: tuple[DataFrame, ...]


def build_tree(bottom: DataFrame, fan: int = FAN) -> Tree:
    """Hash ``fan`` neighbours at a time until every file has one node."""
    spark, path = bottom.sparkSession, scratch_path(bottom.sparkSession, "merkle")

    def stored(frame: DataFrame, level: int) -> DataFrame:
        frame.write.parquet(f"{path}/level-{level}")
        return spark.read.schema(_LEAVES).parquet(f"{path}/level-{level}")

    levels = [stored(bottom, 0)]
    last = levels[0].agg(F.coalesce(F.max("node"), F.lit(0)).alias("n")).first().n
    while last > 0:
        children = F.array_sort(F.collect_list(F.struct("node", "first", "end", "hash")))  # fan at most
        text = F.concat_ws(",", F.transform(children, lambda c: F.concat_ws(":", c.first, c.end, c.hash)))
        above = (
            levels[-1]
            .groupBy("file", F.floor(F.col("node") / fan).alias("node"))
            .agg(F.min("first").alias("first"), F.max("end").alias("end"), F.sha2(text, 256).alias("hash"))
        )
        levels.append(stored(above, len(levels)))
        last //= fan
    return Tree(tuple(levels))


def differing_records(one: Tree, other: Tree, fan: int = FAN) -> DataFrame:
    """``file`` and ``position`` of the records whose hashes differ, or that only one replica has.

    From the roots down, a level is read only for children of nodes that differ. These are
    written level by level, so a plan holds one level whatever the depth.
    """
    depth = max(len(one.levels), len(other.levels))
    suspects: DataFrame | None = None
    left = ""
    for level in reversed(range(depth)):
        sides = []
        for tree in (one, other):
            # A tree with fewer levels has its root, unchanged, on those above.
            nodes = tree.levels[min(level, len(tree.levels) - 1)].select("file", "node", "hash")
            if suspects is not None:
                parents = suspects.withColumnRenamed("node", "parent")
                nodes = nodes.withColumn("parent", F.floor(F.col("node") / fan)).join(parents, ["file", "parent"], "left_semi")
            sides.append(nodes.select("file", "node", "hash"))
        theirs = sides[1].withColumnRenamed("hash", "theirs")
        both = sides[0].join(theirs, ["file", "node"], "full_outer")
        differ = both.where(~F.col("hash").eqNullSafe(F.col("theirs"))).select("file", "node")
        suspects, path = materialize(differ, "suspects")
        if left:
            discard(suspects.sparkSession, left)
        left = path
        if suspects.isEmpty():
            break
    return suspects.withColumnRenamed("node", "position")


def audit(index: DataFrame, one: str, other: str, fan: int = FAN) -> DataFrame:
    """The index with ``record_sha256`` in the first replica, ``damaged`` (do the replicas differ there?) and
    ``end_differs`` (do they differ behind the last record of the file?)."""
    trees = [build_tree(leaves(index, folder), fan) for folder in (one, other)]
    found = differing_records(*trees, fan).withColumn("differs", F.lit(True))
    hashes = trees[0].levels[0].select("file", F.col("node").alias("position"), F.col("hash").alias("record_sha256"))
    ends = index.groupBy("file").agg((F.max("position") + 1).alias("position"))
    longer = found.join(ends, ["file", "position"]).select("file", F.lit(True).alias("longer"))
    return (
        index.join(hashes, ["file", "position"])
        .join(found, ["file", "position"], "left")
        .join(longer, "file", "left")
        .select(
            *["page_id", "file", "position", "offset", "length", "record_sha256"],
            F.coalesce("differs", F.lit(False)).alias("damaged"),
            F.coalesce("longer", F.lit(False)).alias("end_differs"),
        )
    )


def stray_files(index: DataFrame, folder: str) -> DataFrame:
    """``file`` and ``length`` of the files of a replica that the index does not name."""
    listed = index.sparkSession.read.format("binaryFile").load(f"{folder}/data")
    named = index.select("file").distinct()
    return listed.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length").join(named, "file", "left_anti")
