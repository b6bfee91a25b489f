"""Token ids as length-delimited binary records with a separate offset index.

A data file is a row of frames, in the layout of TFRecord files:

    length   8 bytes, little-endian
    checksum 4 bytes, masked CRC-32C of the length
    payload  flags (1 byte), document id (8 bytes, signed), token ids
    checksum 4 bytes, masked CRC-32C of the payload

Flag 1: there is a document id (else the id is null). Flag 2: token ids take
4 bytes, else 2. Files hold documents in ascending id, nulls first; documents
with equal ids follow in the order of a hash of their text.

The index is a Parquet table with a row for each record: file, its number, the
frame's offset and length, and the number of ids. Data files get names of their own for every attempt
of a task and count only when the index names them, so a lost executor or a
task that ran twice leaves at worst an unused file.

Defined results: a null or empty text is the end id alone. An empty table
writes no file. Repeated rows become repeated records.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.pandas.types import to_arrow_schema

from sparkexp.llm.crc32c import crc32c, masked
from sparkexp.llm.rows import position_of
from sparkexp.llm.tokens import encoder

# Text that goes to one data file.
FILE_BYTES = 32_000_000
_AT_ONCE = 128

_INDEX = StructType(
    [
        StructField("file", StringType()),
        StructField("file_no", IntegerType()),
        StructField("offset", LongType()),
        StructField("length", LongType()),
        StructField("n_tokens", LongType()),
    ]
)


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else f"file:{folder}")


def frames(doc_ids: list[int | None], ids: list[bytes], wide: bool) -> list[bytes]:
    """A frame for each document; ``ids`` are little-endian unsigned 32-bit."""
    payloads = []
    for doc_id, raw in zip(doc_ids, ids):
        flags = (doc_id is not None) + 2 * wide
        body = raw if wide else np.frombuffer(raw, "<u4").astype("<u2").tobytes()
        payloads.append(bytes([flags]) + (doc_id or 0).to_bytes(8, "little", signed=True) + body)
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    heads, tails = masked(crc32c(lengths)).astype("<u4"), masked(crc32c(payloads)).astype("<u4")
    return [a + h.tobytes() + p + t.tobytes() for a, h, p, t in zip(lengths, heads, payloads, tails)]


def parse(found: list[bytes]) -> list[tuple[int | None, bytes]]:
    """Document id and 32-bit ids of each frame; a frame that does not fit its checksums is an error."""
    if any(len(f) < 25 or len(f) != int.from_bytes(f[:8], "little") + 16 for f in found):
        raise ValueError("A record's length does not fit its frame.")
    payloads = [f[12:-4] for f in found]
    heads = masked(crc32c([f[:8] for f in found]))
    tails = masked(crc32c(payloads))
    out = []
    for frame, payload, head, tail in zip(found, payloads, heads.tolist(), tails.tolist()):
        if int.from_bytes(frame[8:12], "little") != head or int.from_bytes(frame[-4:], "little") != tail:
            raise ValueError("A record does not fit its checksum.")
        flags, body = payload[0], payload[9:]
        wide = body if flags & 2 else np.frombuffer(body, "<u2").astype("<u4").tobytes()
        out.append((int.from_bytes(payload[1:9], "little", signed=True) if flags & 1 else None, wide))
    return out


def write_records(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    file_bytes: int = FILE_BYTES,
    added_tokens: bool = False,
) -> DataFrame:
    """Write data files and index below ``folder``; returns the index.

    Rows are dealt by ranges of id, and of a text hash among equal ids, so that
    an id held by many rows is spread. Only ids and texts are shuffled, once.
    """
    spark = docs.sparkSession
    pair = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))]).select(
        F.col(f"_{position_of(docs, doc_id)}").cast("long").alias("doc_id"), F.col(f"_{position_of(docs, text)}").alias("text")
    )
    total = pair.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0)).alias("n")).first().n
    files = max(1, -(-total // file_bytes))
    tie = F.xxhash64("text")
    dealt = pair.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), tie)
    # The text itself does not take part in the sort; rows with equal texts are alike.
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    data, arrow = f"{folder}/data", to_arrow_schema(_INDEX)
    store, root = _store(data)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = encoder(vocabulary, added_tokens), TaskContext.get().partitionId()
        wide = own.tokenizer.get_vocab_size() > 1 << 16
        place, top = _store(data)
        name, at, out = f"part-{number:06d}-{uuid.uuid4().hex}.rec", 0, None
        try:
            for names, encoded in own.encode_rows(batches):
                for start in range(0, len(names), _AT_ONCE):
                    ids = encoded[start : start + _AT_ONCE]
                    made = frames(names[start : start + _AT_ONCE], ids, wide)
                    out = out or place.open_output_stream(f"{top}/{name}")
                    out.write(b"".join(made))
                    sizes = [len(f) for f in made]
                    offsets = (at + np.cumsum([0, *sizes[:-1]])).tolist()
                    at += sum(sizes)
                    columns = [[name] * len(made), [number] * len(made), offsets, sizes, [len(raw) // 4 for raw in ids]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, arrow)], schema=arrow)
        finally:
            if out:
                out.close()

    dealt.mapInArrow(write, _INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str, files: int, with_ids: bool = True) -> DataFrame:
    """The records of the index rows given, all or some: doc_id, ids, file number, offset.

    ``ids`` are little-endian unsigned 32-bit. Rows are dealt by file and read
    in the order of their offsets; every checksum is verified. Without ``with_ids`` the ids
    stay in the task that read them: their number ``n_tokens`` and ``ids_crc32`` come instead.
    """
    data = f"{folder}/data"
    found_fields = [StructField("ids", BinaryType())] if with_ids else [StructField("n_tokens", LongType()), StructField("ids_crc32", LongType())]
    schema = StructType(
        [StructField("doc_id", LongType()), *found_fields, StructField("file_no", IntegerType()), StructField("offset", LongType())]
    )
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(data)
        name, source = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(start, _AT_ONCE)
                columns = [part.column(i).to_pylist() for i in range(4)]
                found = []
                for file, offset, length in zip(columns[0], columns[2], columns[3]):
                    if file != name:
                        if source:
                            source.close()
                        name, source = file, store.open_input_file(f"{root}/{file}")
                    source.seek(offset)
                    found.append(source.read(length))
                rows = parse(found)
                ids = [raw for _, raw in rows]
                told = [ids] if with_ids else [[len(raw) // 4 for raw in ids], [zlib.crc32(raw) for raw in ids]]
                values = [[d for d, _ in rows], *told, columns[1], columns[2]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, arrow)], schema=arrow)
        if source:
            source.close()

    dealt = index.select("file", "file_no", "offset", "length").repartition(max(1, files), "file")
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(read, schema)


def digest(records: DataFrame, index: DataFrame) -> DataFrame:
    """Where each document starts in the whole, its number of ids and their checksum."""
    told = ["n_tokens", "ids_crc32"]
    if "ids" in records.columns:
        told = [(F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")]
    rows = records.select("doc_id", "file_no", "offset", *told)
    in_file = Window.partitionBy("file_no").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0)))
    # One row a file.
    ahead = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = index.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    base = files.select("file_no", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    return local.join(base, "file_no").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def number_of_files(spark: SparkSession, index: DataFrame) -> int:
    """Data files that the index names."""
    return index.agg(F.coalesce(F.max("file_no") + 1, F.lit(1)).alias("n")).first().n
