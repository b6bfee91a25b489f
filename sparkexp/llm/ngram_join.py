"""N-gram Jaccard self-join with Bayesian candidate pruning.

1. A text becomes the set of its five-word shingles (lower-case words of letters,
   digits and non-ASCII characters; a text of fewer words is one shingle). Texts
   with equal sets are one class, counted, and take part once.
2. Classes that share a band of MinHash values are candidates. Only band keys are
   shuffled for this. Bands that hold the same classes count once.
3. Within a band's group, pairs compare their MinHash values step by step. With m
   of n values equal, the posterior probability of a Jaccard of ``threshold`` or more
   (uniform prior) is a beta tail; once it falls below ``tolerance`` the pair is
   dropped. Components of what is left are the groups that may hold links.
4. The shingles of these groups are gathered: documents whose id is not in a bitmap
   of fixed size are left out where they are read. Pairs are pruned in the same way, and
   what is left is verified on the shingles themselves. Every pair meets once.

A group that is too large for one task is cut into blocks, and every pair of
blocks is a task of its own. Pairs never leave a task: what comes out is the number
of links of each class and the edges of a spanning forest.

At a similarity of exactly 0.8, 28 bands of 4 values miss a pair with a probability of
4e-7 and pruning with 1e-6; above that less. Nothing that is no link is reported.

Defined results: a text without words (null, empty) has no links and is a class of
its own, ``class_id`` being its document id. Repeated rows and equal texts are links
of each other. Null document ids are counted, and never name a class that has
another id. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from sparkexp.llm.components import connected_components
from sparkexp.llm.rows import ROWS_AT_ONCE, add_columns, position_of
from sparkexp.llm.worker import release
from sparkexp.sources.scratch import discard, materialize

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, BAND_VALUES = 28, 4
VALUES = BANDS * BAND_VALUES
# MinHash values compared between two looks at the posterior.
STEP = 16
# Members of a band's group, and shingles of a group, in one block.
BLOCK_CLASSES = 2_000
BLOCK_SHINGLES = 1_000_000
SEED = 11

_WORD_BREAKS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_MULTIPLIERS = np.random.default_rng(SEED).integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(SEED + 1).integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(_WORD_BREAKS).split()
    if not raw:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, len(raw))
    count = max(1, len(raw) - words + 1)
    mixed = np.zeros(count, np.uint64)
    for k in range(min(words, len(raw))):
        part = hashes[k : k + count]
        mixed += (part ^ (part >> np.uint64(31))) * _PLACES[k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def minhash(found: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the shingles."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 2048):
        np.minimum(least, (found[start : start + 2048, None] * _MULTIPLIERS).min(axis=0), out=least)
    return least


@lru_cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[tuple[int, int], ...]:
    """For n values compared, the fewest matches at which the posterior still reaches ``tolerance``.

    With a uniform prior the posterior after m of n matches is Beta(m+1, n-m+1),
    whose tail above t is the chance of at most m successes in n+1 trials of t.
    """

    def tail(m: int, n: int) -> float:
        return sum(math.comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))

    return tuple((n, next(m for m in range(n + 1) if tail(m, n) >= tolerance)) for n in range(STEP, VALUES + 1, STEP))


def surviving_pairs(left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of ``left`` the rows of ``right`` that incremental comparison does not drop.

    With ``same`` both are one block, and only later rows are compared.
    """
    limits = least_matches()
    for i in range(len(left)):
        first = i + 1 if same else 0
        rows = np.arange(first, len(right))
        matches = np.zeros(len(rows), np.int32)
        at = 0
        for n, fewest in limits:
            if not len(rows):
                break
            matches += (right[rows, at:n] == left[i, at:n]).sum(axis=1, dtype=np.int32)
            stay = matches >= fewest
            rows, matches, at = rows[stay], matches[stay], n
        if len(rows):
            yield i, rows


class _Forest:
    """Union of places; keeps an edge only where it joins two trees."""

    def __init__(self, size: int) -> None:
        self.parent = list(range(size))
        self.edges: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, others: list[int]) -> None:
        for y in others:
            a, b = self.find(x), self.find(y)
            if a != b:
                self.parent[b] = a
                self.edges.append((x, y))


_PREPARED = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("class", BinaryType()),
        StructField("n_shingles", IntegerType()),
        StructField("signature", BinaryType()),
        StructField("bands", BinaryType()),
        StructField("short", LongType()),
    ]
)


def _prepare(pair: DataFrame) -> DataFrame:
    """Class (a 128-bit hash of the shingle set), signature and band keys of each document."""
    arrow = to_arrow_schema(_PREPARED)

    def one(text: str | None) -> tuple:
        found = shingles(text)
        if not len(found):
            return None, 0, None, None, None
        least = minhash(found)
        short = (least >> np.uint64(24) & np.uint64(0xFFFF)).astype("<u2")
        mixed = np.zeros(BANDS, np.uint64)
        for k, column in enumerate(least.reshape(BANDS, BAND_VALUES).T):
            mixed = (mixed ^ (column >> np.uint64(k + 7))) * np.uint64(0x9E3779B97F4A7C15) + column
        keys = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + np.arange(BANDS, dtype=np.uint64)
        name = xxhash.xxh3_128_digest(found.tobytes())
        first = int.from_bytes(name[:8], "little", signed=True)
        return name, len(found), short.tobytes(), keys.astype("<u8").tobytes(), first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                columns = [part.column(0), *[list(v) for v in zip(*map(one, part.column(1).to_pylist()))]]
                made = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(made, schema=arrow)

    return pair.mapInArrow(run, _PREPARED)


def _band_rows(classes: DataFrame) -> DataFrame:
    """A row for each class and band; classes by the first 64 bits of their hash, which may at worst add a candidate."""
    schema = StructType([StructField("key", LongType()), StructField("short", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            names = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")[::2]
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(names, BANDS))], schema=arrow)

    return classes.select("class", "bands").mapInArrow(run, schema)


def _in_blocks(rows: DataFrame, group: str, blocks) -> DataFrame:
    """Copies of each row for every pair of blocks that its own block is in: ``low``, ``high``, ``block``.

    A group of one block is not copied; one of g blocks is copied g times.
    """
    own = F.pmod(F.xxhash64("class", F.lit(SEED)), F.col("_blocks")).cast("int")
    numbered = rows.withColumn("_blocks", blocks).withColumn("block", own)
    other = F.explode(F.sequence(F.lit(0), (F.col("_blocks") - 1).cast("int")))
    return (
        numbered.withColumn("_other", other)
        .withColumn("low", F.least("block", "_other"))
        .withColumn("high", F.greatest("block", "_other"))
        .drop("_other", "_blocks")
    )


def _halves(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the two blocks of a task, and whether they are one."""
    block = table.column("block").to_numpy()
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    if low == high:
        every = np.arange(len(block))
        return every, every, True
    return np.flatnonzero(block == low), np.flatnonzero(block == high), False


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u2").reshape(-1, VALUES)


_EDGES = StructType([StructField("a", BinaryType()), StructField("b", BinaryType())])
_EDGES_ARROW = to_arrow_schema(_EDGES)


def _likely_edges(table: pa.Table) -> pa.Table:
    """A spanning forest of the pairs in a band's group that pruning leaves."""
    left, right, same = _halves(table)
    signatures, forest = _signatures(table), _Forest(table.num_rows)
    for i, found in surviving_pairs(signatures[left], signatures[right], same):
        forest.join(int(left[i]), right[found].tolist())
    names = table.column("class").to_pylist()
    pairs = [(names[a], names[b]) for a, b in forest.edges]
    return pa.table([[a for a, _ in pairs], [b for _, b in pairs]], schema=_EDGES_ARROW)


_LINKS = StructType(
    [StructField("class", BinaryType()), StructField("linked_docs", LongType()), StructField("to", BinaryType())]
)
_LINKS_ARROW = to_arrow_schema(_LINKS)


def _verified_links(table: pa.Table) -> pa.Table:
    """Linked documents of each class, verified on the shingles, and a spanning forest of the links."""
    left, right, same = _halves(table)
    signatures, forest = _signatures(table), _Forest(table.num_rows)
    flat = np.frombuffer(b"".join(table.column("shingles").to_pylist()), "<u8")
    size = table.column("n_shingles").to_numpy().astype(np.int64)
    docs = table.column("n_docs").to_numpy()
    ends = np.cumsum(size)
    distinct, ids = np.unique(flat, return_inverse=True)
    marked = np.zeros(len(distinct), bool)
    linked = np.zeros(table.num_rows, np.int64)
    for i, found in surviving_pairs(signatures[left], signatures[right], same):
        x, others = int(left[i]), right[found]
        # No link where one set is too small for the other.
        fits = np.minimum(size[others], size[x]) >= THRESHOLD * np.maximum(size[others], size[x]) - 1e-9
        others = others[fits]
        if not len(others):
            continue
        marked[ids[ends[x] - size[x] : ends[x]]] = True
        for start in range(0, len(others), 512):
            part = others[start : start + 512]
            counts = size[part]
            firsts = np.cumsum(counts) - counts
            inside = np.arange(counts.sum()) - np.repeat(firsts, counts) + np.repeat(ends[part] - counts, counts)
            common = np.add.reduceat(marked[ids[inside]].astype(np.int64), firsts)
            # Jaccard of at least 0.8 without a division, in tenths.
            links = part[10 * common >= round(10 * THRESHOLD) * (size[x] + counts - common)]
            linked[x] += docs[links].sum()
            linked[links] += docs[x]
            forest.join(x, links.tolist())
        marked[ids[ends[x] - size[x] : ends[x]]] = False
    names = table.column("class").to_pylist()
    seen = np.flatnonzero(linked).tolist()
    one = [names[k] for k in seen] + [names[a] for a, _ in forest.edges]
    count = linked[seen].tolist() + [0] * len(forest.edges)
    to = [None] * len(seen) + [names[b] for _, b in forest.edges]
    return pa.table([one, count, to], schema=_LINKS_ARROW)


def _grouped(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The class of each document, and for each class: id and links, its smallest document id, and whether its group keeps it."""
    spark = docs.sparkSession
    made: list[str] = []

    def written(frame: DataFrame, label: str) -> DataFrame:
        stored, path = materialize(frame, label)
        made.append(path)
        return stored

    pair = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))]).select(
        F.col(f"_{position_of(docs, doc_id)}").cast("long").alias("doc_id"), F.col(f"_{position_of(docs, text)}").alias("text")
    )
    prepared = written(_prepare(pair), "prepared")
    classes = written(
        prepared.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.min("doc_id").alias("first_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
            F.first("short").alias("short"),
        ),
        "classes",
    )

    bands = _band_rows(classes)
    members = [F.bit_xor("short").alias("members"), F.bit_xor(F.xxhash64("short")).alias("mixed")]
    grouped = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *members).where("n > 1")
    kept = grouped.groupBy("n", "members", "mixed").agg(F.min("key").alias("key")).select("key", "n")
    candidates = written(bands.join(kept, "key"), "candidates")
    signed = candidates.join(classes.select("class", "signature", "short"), "short").drop("short")
    in_blocks = _in_blocks(signed, "key", F.ceil(F.col("n") / BLOCK_CLASSES))
    likely = in_blocks.groupBy("key", "low", "high").applyInArrow(_likely_edges, _EDGES)
    groups = written(connected_components(likely), "groups")

    weight = groups.join(classes.select(F.col("class").alias("node"), "n_shingles", "n_docs", "first_id", "signature"), "node")
    weight = written(weight.withColumnRenamed("node", "class"), "weights")
    sizes = weight.groupBy("root").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks"))
    # Shingles of one document of each class that may have links. An id can be shared by several texts, so the class decides.
    shingled = (
        _shingles_of(pair, _id_bits(weight.select("first_id")))
        .join(weight.select("class"), "class", "left_semi")
        .groupBy("class")
        .agg(F.first("shingles").alias("shingles"))
    )
    full = weight.drop("first_id").join(sizes, "root").join(shingled, "class")
    in_blocks = _in_blocks(full, "root", F.col("blocks"))
    links = in_blocks.groupBy("root", "low", "high").applyInArrow(_verified_links, _LINKS)
    links = written(links, "links")

    roots = connected_components(links.where(F.col("to").isNotNull()).select(F.col("class").alias("a"), F.col("to").alias("b")))
    counts = links.groupBy("class").agg(F.sum("linked_docs").alias("linked_docs"))
    found = classes.select("class", "n_docs", "first_id").join(counts, "class", "left")
    found = found.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    # Only classes with links share a root; the rest need no shuffle for their smallest id.
    least = F.min(F.struct(F.col("first_id").isNull().alias("unnamed"), "first_id", "class")).alias("least")
    named = found.groupBy("root").agg(least)
    answer = written(
        found.join(named, "root").select(
            "class",
            F.col("least.first_id").alias("class_id"),
            (F.col("n_docs") - 1 + F.coalesce("linked_docs", F.lit(0))).alias("n_links"),
            "first_id",
            (F.col("class") == F.col("least.class")).alias("keeps"),
        ),
        "answer",
    )
    for path in made:
        if not any(part in path for part in ("prepared-", "answer-")):
            discard(spark, path)
    return prepared.select("doc_id", "class"), answer


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: ``doc_id``, ``class_id``, ``n_links``.

    ``class_id`` is the smallest id among all documents that links connect;
    ``n_links`` is the number of other documents with a similarity of 0.8 or more.
    """
    prepared, answer = _grouped(docs, doc_id, text)
    worded = prepared.where(F.col("class").isNotNull()).join(answer.select("class", "class_id", "n_links"), "class")
    wordless = prepared.where(F.col("class").isNull())
    return worded.select("doc_id", "class_id", "n_links").unionByName(
        wordless.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with one of each group of near-duplicates: that with the smallest id.

    Texts without words are no duplicates of each other and all stay. Of rows
    with the kept id and the same shingles one stays. The rows are shuffled once.
    """
    _, answer = _grouped(docs, doc_id, text)
    # Numbered, so that no column of the user's is taken for one that is added here.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    name, body = F.col(f"c{position_of(docs, doc_id)}"), f"c{position_of(docs, text)}"
    known = add_columns(numbered, [body], [StructField("_class", BinaryType())], lambda: lambda c: [[class_of(t) for t in c[0]]])
    # Null ids as values, so that all three parts of the key are plain columns.
    keyed = known.withColumns({"_null": name.isNull(), "_id": F.coalesce(name.cast("long"), F.lit(0))})
    kept = answer.where("keeps").select(
        F.col("class").alias("_class"), F.col("first_id").isNull().alias("_null"), F.coalesce("first_id", F.lit(0)).alias("_id")
    )
    key = ["_class", "_null", "_id"]
    worded = keyed.where(F.col("_class").isNotNull()).join(kept, key, "left_semi").dropDuplicates(key)
    kept_rows = worded.unionByName(keyed.where(F.col("_class").isNull()))
    return kept_rows.select(*numbered.columns).toDF(*docs.columns)


def class_of(text: str | None) -> bytes | None:
    """The class of a text: a 128-bit hash of its shingle set; null without words."""
    found = shingles(text)
    return xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None


_BITS = 1 << 26
_BUCKET_BITS = 1 << 15  # in one row of Spark's bitmap functions


def _bit(name: str):
    return F.pmod(F.xxhash64(name, F.lit(SEED)), F.lit(_BITS))


def _id_bits(ids: DataFrame) -> np.ndarray:
    """A bitmap of hashed ids, of a fixed size (8 MB) whatever their number."""
    bit = ids.select((_bit(ids.columns[0]) + 1).alias("bit"))
    rows = (
        bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    found = np.zeros(_BITS // 8, np.uint8)
    for row in rows:
        start = (row.bucket - 1) * _BUCKET_BITS // 8
        found[start : start + _BUCKET_BITS // 8] = np.frombuffer(bytes(row.bits), np.uint8)
    return found


def _shingles_of(pair: DataFrame, bits: np.ndarray) -> DataFrame:
    """``class`` and ``shingles`` of the documents whose id is in the bitmap; a few more pass by chance."""
    shared = pair.sparkSession.sparkContext.broadcast(bits)
    schema = StructType([StructField("class", BinaryType()), StructField("shingles", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            bit = batch.column(0).to_numpy()
            wanted = np.flatnonzero(shared.value[bit >> 3] >> (bit & 7) & 1)
            for start in range(0, len(wanted), ROWS_AT_ONCE):
                texts = batch.column(1).take(pa.array(wanted[start : start + ROWS_AT_ONCE])).to_pylist()
                found = [s for s in map(shingles, texts) if len(s)]
                names = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary())
                values = pa.array([s.astype("<u8").tobytes() for s in found], pa.binary())
                yield pa.RecordBatch.from_arrays([names, values], schema=arrow)

    return pair.select(_bit("doc_id").alias("bit"), "text").mapInArrow(run, schema)
