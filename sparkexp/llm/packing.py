"""Bounded-space packing of token sequences into windows of a fixed length.

A document's ids are cut into whole windows and a rest. Every partition keeps at
most ``open_windows`` windows open: a rest goes where it leaves least room; when
it fits nowhere and all are open, the fullest is emitted. The windows still open
at the end of each partition are merged: pieces of a bounded number of
partitions at a time, longest first, each where it leaves least room.

Partitions are those of the input, so the texts are not shuffled. The packed
pieces are written once to the shared folder, as the merge and the result both
read them.

Defined results: a null or empty text is the end id alone. An empty table has no
pieces. Repeated rows are packed one by one. A null document id stays null.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from sparkexp.llm.rows import position_of
from sparkexp.llm.tokens import BYTES_KEPT, encoder
from sparkexp.sources.scratch import scratch_path

WINDOW = 1024
OPEN_WINDOWS = 64
# Partitions whose open windows are merged together.
MERGED_PARTITIONS = 64
_AT_ONCE = 128

Piece = tuple


class Packer:
    """Best fit into a bounded number of open windows."""

    def __init__(self, size: int = WINDOW, most: int = OPEN_WINDOWS) -> None:
        self.size, self.most = size, most
        self.room: list[tuple[int, int]] = []  # (free, window), sorted
        self.open: dict[int, list[Piece]] = {}
        self.windows = 0

    def place(self, length: int, piece: Piece) -> list[tuple[int, list[Piece]]]:
        """Put a piece into a window; returns the windows that this closed."""
        closed = []
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            free, window = self.room.pop(at)
        else:
            if len(self.room) >= self.most:
                closed.append(self._close(*self.room.pop(0)))
            free, window = self.size, self.windows
            self.windows += 1
            self.open[window] = []
        self.open[window].append(piece)
        if free == length:
            closed.append(self._close(0, window))
        else:
            insort(self.room, (free - length, window))
        return closed

    def _close(self, _: int, window: int) -> tuple[int, list[Piece]]:
        return window, self.open.pop(window)

    def rest(self) -> list[tuple[int, list[Piece]]]:
        """The windows still open."""
        left = sorted(self.open.items())
        self.open, self.room = {}, []
        return left


def best_fit_decreasing(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece when the longest is placed first."""
    packer_room: list[tuple[int, int]] = []
    window_of, offset_of, windows = [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        at = bisect_left(packer_room, (lengths[i], -1))
        if at < len(packer_room):
            free, window = packer_room.pop(at)
        else:
            free, window, windows = size, windows, windows + 1
        window_of[i], offset_of[i] = window, size - free
        insort(packer_room, (free - lengths[i], window))
    return window_of, offset_of


_PIECES = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids", BinaryType()),
        StructField("doc_tokens", LongType()),
        StructField("sequence_id", LongType()),
        StructField("offset", LongType()),
        StructField("task", IntegerType()),
        StructField("piece", LongType()),
        StructField("is_open", BooleanType()),
    ]
)
_MERGED = "task int, piece long, sequence_id long, offset long"
# Sequence ids: task number, then the window's number in the task; merged ones lie above all those.
_TASK_BITS = 33
_MERGED_BASE = 1 << 62


def pack(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    merged_partitions: int = MERGED_PARTITIONS,
    added_tokens: bool = False,
    bytes_kept: int = BYTES_KEPT,
) -> DataFrame:
    """One row for each piece, with its ids (little-endian unsigned 32-bit), sequence and offset.

    ``bytes_kept`` bounds each of the two generations of pieces that a worker remembers.
    """
    spark = docs.sparkSession
    pair = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))]).select(
        F.col(f"_{position_of(docs, doc_id)}").cast("long").alias("doc_id"), F.col(f"_{position_of(docs, text)}").alias("text")
    )
    arrow = to_arrow_schema(_PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = encoder(vocabulary, added_tokens, bytes_kept), Packer(size, open_windows)
        task, pieces = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []

        def emit(closed: list[tuple[int, list[Piece]]], is_open: bool) -> None:
            for window, content in closed:
                at = 0
                for number, name, start, length, ids, whole in content:
                    rows.append((name, start, length, ids, whole, (task << _TASK_BITS) + window, at, task, number, is_open))
                    at += length

        def batch_of() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[] for _ in arrow]
            made = pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(columns, arrow)], schema=arrow)
            rows.clear()
            return made

        for names, encoded in own.encode_rows(batches):
            for name, raw in zip(names, encoded):
                whole = len(raw) // 4
                for start in range(0, whole, size):
                    length = min(size, whole - start)
                    piece = (pieces, name, start, length, raw[4 * start : 4 * (start + length)], whole)
                    pieces += 1
                    emit(packer.place(length, piece), False)
                if len(rows) >= _AT_ONCE:
                    yield batch_of()
        emit(packer.rest(), True)
        yield batch_of()

    path = scratch_path(spark, "pieces")
    pair.mapInArrow(run, _PIECES).write.partitionBy("is_open").option("compression", "zstd").parquet(path)
    written = spark.read.schema(_PIECES).parquet(path)

    def merge(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["task", "piece"], ignore_index=True)
        windows, offsets = best_fit_decreasing(frame["length"].tolist(), size)
        first = _MERGED_BASE + (int(group[0]) << _TASK_BITS)
        frame["sequence_id"], frame["offset"] = [first + w for w in windows], offsets
        return frame[["task", "piece", "sequence_id", "offset"]]

    left = written.where("is_open").select("task", "piece", "length", F.floor(F.col("task") / merged_partitions).alias("part"))
    merged = left.groupBy("part").applyInPandas(merge, _MERGED)
    columns = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    emitted = written.where(~F.col("is_open")).select(columns)
    rest = written.where("is_open").drop("sequence_id", "offset").join(merged, ["task", "piece"]).select(columns)
    return emitted.unionByName(rest)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
