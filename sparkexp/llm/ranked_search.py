"""Ranked lexical search by pipelined term partitioning.

The documents become an inverted index in blocks: a task reads its documents whole and
writes, for each block of them, one row a term with the places and counts of the
term, and one row with the ids and lengths. Only terms that some item may use are kept
(by a bitmap of fixed size, then by an exact join).

The terms are dealt to owners by falling weight, so that each owner has a like share of the
postings. Items travel in bundles. A bundle visits the owners one after another, for every block at once:
in each stage its sparse accumulators (item, document, score so far) meet the postings of that
stage's owner in a cogroup, and the owner's integer contributions are added. Between stages
the accumulators are written to the shared folder, and each item's tenth best score so
far, over all blocks, becomes its threshold. An accumulator that cannot reach the threshold with all that
the later owners could add at most is dropped, which changes no result: scores never fall.
After the last stage each block names its best documents for each item, and a ranking of these
gives the answer.

Scores are whole numbers, as in the contract of the query (``op12``): the weight of a term
is floor(1000 ln((2N + 2) / (2 df + 1))), its contribution weight times (10^9 tf) div (1000 tf + 8 m) with
m = 25 + (75 n N) div L. Terms of weight 0 add nothing and are left out.

Nothing grows in one place: a block holds ``BLOCK_DOCS`` documents or ``BLOCK_POSTINGS`` postings at
most, a bundle about ``BUNDLE_ITEMS`` items, and the keys of the cogroup are block and bundle. A term that
stands in every document has one row a block. The table of uses is broadcast up to ``BROADCAST_BYTES``;
beyond, it is joined by a shuffle in which each term is dealt to ``SALTS`` keys.
To the driver come N, L, the bitmap (2 MB) and the postings for each weight (some 25,000 numbers).

Defined results: a null text has no terms. Documents without terms are not counted and never found;
items without terms have no answers. Every row of the documents is a document, repeated rows and ids
too; equal scores are ordered by id, null ids last. Items alike in id and text are one item. Ids of
documents must be integers. Other columns are not looked at. Empty tables give an empty answer.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from sparkexp.llm.rows import ROWS_AT_ONCE, add_columns, position_of, words_of
from sparkexp.sources.scratch import discard, materialize

TOP = 10
OWNERS = 4
BUNDLE_ITEMS = 256
BLOCK_DOCS = 16_384
BLOCK_POSTINGS = 2_000_000
BROADCAST_BYTES = 16_000_000
SALTS = 16
_SLOTS = 1 << 24
_BUCKET_BITS = 1 << 15  # in one row of Spark's bitmap functions
_TEXT_AT_ONCE = 4_000_000
_REJECTED_KEPT = 200_000

INDEX = StructType(
    [
        StructField("block", LongType()),
        StructField("term", BinaryType()),  # null in the row that describes the block
        StructField("size", LongType()),  # postings, or documents of the block
        StructField("top", LongType()),  # highest count, or terms of the block's documents with repeats
        StructField("places", BinaryType()),
        StructField("counts", BinaryType()),
        StructField("ids", ArrayType(LongType())),
        StructField("lengths", BinaryType()),
    ]
)
STATE = StructType(
    [
        StructField("bundle", IntegerType()),
        StructField("block", LongType()),
        StructField("items", BinaryType()),
        StructField("places", BinaryType()),
        StructField("scores", BinaryType()),
        StructField("best_items", ArrayType(IntegerType())),
        StructField("best_scores", ArrayType(LongType())),
    ]
)
FOUND = StructType(
    [
        StructField("bundle", IntegerType()),
        StructField("slot", IntegerType()),
        StructField("doc_id", LongType()),
        StructField("score", LongType()),
    ]
)


def count_terms(text: str | None) -> Counter:
    """How often each term occurs; a long text is read piece by piece."""
    if not text or len(text) <= _TEXT_AT_ONCE:
        return Counter(words_of(text))
    counts: Counter = Counter()
    start = 0
    while start < len(text):
        end = start + _TEXT_AT_ONCE
        while end < len(text) and (text[end] > "\x7f" or text[end].isalnum()):
            end += 1
        counts.update(words_of(text[start:end]))
        start = end
    return counts


class BlockWriter:
    """Gathers documents to blocks of the index."""

    def __init__(self, partition: int, bits: np.ndarray, block_docs: int, block_postings: int) -> None:
        self.block, self.bits = partition << 32, bits
        self.block_docs, self.block_postings = block_docs, block_postings
        self.rejected: set[bytes] = set()
        self.schema = to_arrow_schema(INDEX)
        self._start()

    def _start(self) -> None:
        self.terms: dict[bytes, tuple[list[int], list[int]]] = {}
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.postings = 0

    def add(self, doc_id: int | None, text: str | None) -> bool:
        """Add a document; true when the block is full."""
        counts = count_terms(text)
        if not counts:
            return False
        place, terms, rejected = len(self.ids), self.terms, self.rejected
        for term, count in counts.items():
            entry = terms.get(term)
            if entry is None:
                if term in rejected:
                    continue
                slot = zlib.crc32(term) % _SLOTS
                if not self.bits[slot >> 3] >> (slot & 7) & 1:
                    if len(rejected) >= _REJECTED_KEPT:
                        rejected.clear()
                    rejected.add(term)
                    continue
                entry = terms[term] = ([], [])
            entry[0].append(place)
            entry[1].append(count)
            self.postings += 1
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        return len(self.ids) >= self.block_docs or self.postings >= self.block_postings

    def flush(self) -> Iterator[pa.RecordBatch]:
        """The block's rows; the next block begins."""
        if not self.ids:
            return
        rows = [(self.block, None, len(self.ids), sum(self.lengths), None, None, self.ids, np.array(self.lengths, "<i8").tobytes())]
        for term, (places, counts) in self.terms.items():
            packed = (np.array(places, "<i4").tobytes(), np.array(counts, "<i4").tobytes())
            rows.append((self.block, term, len(places), max(counts), *packed, None, None))
        for start in range(0, len(rows), 1000):
            columns = zip(*rows[start : start + 1000])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.block += 1
        self._start()


def _term_bits(terms: DataFrame) -> np.ndarray:
    """A bitmap of the terms' checksums, of a fixed size (2 MB) whatever their number."""
    bit = terms.select((F.pmod(F.crc32("term"), F.lit(_SLOTS)) + 1).alias("bit"))
    rows = (
        bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    found = np.zeros(_SLOTS // 8, np.uint8)
    for row in rows:
        start = (row.bucket - 1) * _BUCKET_BITS // 8
        found[start : start + _BUCKET_BITS // 8] = np.frombuffer(bytes(row.bits), np.uint8)
    return found


def build_index(docs: DataFrame, bits: np.ndarray, key: str, text: str, block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The inverted index in blocks, of terms that pass the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    pair = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))]).select(
        F.col(f"_{position_of(docs, key)}").cast("long"), F.col(f"_{position_of(docs, text)}").cast("string")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BlockWriter(TaskContext.get().partitionId(), shared.value, block_docs, block_postings)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                for doc_id, body in zip(part.column(0).to_pylist(), part.column(1)):
                    if writer.add(doc_id, body.as_py()):
                        yield from writer.flush()
        yield from writer.flush()

    return pair.mapInArrow(run, INDEX)


def bundle_items(items: DataFrame, key: str, text: str, bundle_items: int = BUNDLE_ITEMS) -> DataFrame:
    """Each distinct item with its terms, its bundle and its place there."""
    pair = items.toDF(*[f"_{i}" for i in range(len(items.columns))]).select(
        F.col(f"_{position_of(items, key)}").alias("item_id"), F.col(f"_{position_of(items, text)}").cast("string").alias("text")
    )
    added = [StructField("terms", ArrayType(BinaryType())), StructField("counts", ArrayType(LongType()))]

    def make():
        def function(columns):
            counted = [count_terms(body) for body in columns[0]]
            return [[list(c) for c in counted], [list(c.values()) for c in counted]]

        return function

    worded = add_columns(pair.distinct(), ["text"], added, make).where(F.size("terms") > 0)
    bundles = -(-worded.count() // bundle_items)
    numbered = worded.withColumn("bundle", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, bundles))).cast("int"))
    place = F.row_number().over(Window.partitionBy("bundle").orderBy("item_id", "text")) - 1
    return numbered.select("bundle", place.alias("slot"), "item_id", "terms", "counts")


def _weights(index: DataFrame, item_terms: DataFrame, documents: int) -> DataFrame:
    """The uses of each term by each bundle, with the term's weight and the most it adds to a score."""
    known = index.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("size").alias("df"), F.max("top").alias("top"))
    # The division and the logarithm are in doubles, all else in whole numbers.
    share = F.lit(2 * documents + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.log(share)).cast("long")
    # A document's m is 25 at least.
    most = F.expr("(1000000000L * top) div (1000L * top + 200L)")
    uses = item_terms.groupBy("term", "bundle").agg(F.collect_list(F.struct("slot", "count")).alias("uses"))
    weighted = uses.join(known.withColumn("weight", weight), "term").where("weight > 0")
    return weighted.select(
        "term",
        "bundle",
        "weight",
        "df",
        F.col("uses.slot").alias("slots"),
        F.transform("uses.count", lambda count: count * F.col("weight")).alias("weights"),
        most.alias("most"),
    )


def owner_limits(postings_by_weight: list[tuple[int, int]], owners: int) -> list[int]:
    """Weights at which one owner's terms end and the next one's begin, for like shares of the postings."""
    total, so_far, limits = sum(n for _, n in postings_by_weight), 0, []
    for weight, postings in sorted(postings_by_weight, reverse=True):
        while len(limits) < owners - 1 and so_far >= total * (len(limits) + 1) / owners:
            limits.append(weight)
        so_far += postings
    return limits + [-1] * (owners - 1 - len(limits))


def _add_contributions(left: pa.Table, right: pa.Table, documents: int, terms: int) -> tuple[dict, dict]:
    """Scores by item, and ids by place, of one bundle and block after an owner's stage."""
    described = right.filter(pc.is_valid(right.column("ids")))
    lengths = np.frombuffer(described.column("lengths")[0].as_py(), "<i8").tolist()
    # Python's whole numbers, since the product may pass 64 bits.
    m = np.array([25 + (75 * n * documents) // terms for n in lengths], np.int64)
    postings = right.filter(pc.is_null(right.column("ids")))
    by_item: dict[int, list] = defaultdict(list)
    rows = zip(*[postings.column(name) for name in ("places", "counts", "slots", "weights")])
    for places, counts, slots, weights in rows:
        place = np.frombuffer(places.as_py(), "<i4")
        tf = np.frombuffer(counts.as_py(), "<i4").astype(np.int64)
        part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[place])
        for slot, weight in zip(slots.as_py(), weights.as_py()):
            by_item[slot].append((place, part, weight))
    state = {name: np.frombuffer(left.column(name)[0].as_py(), kind) for name, kind in (("items", "<i4"), ("places", "<i4"), ("scores", "<i8"))}
    kept_items, first = np.unique(state["items"], return_index=True)
    ends = np.append(first[1:], len(state["items"]))
    carried = {int(i): slice(a, b) for i, a, b in zip(kept_items, first, ends)}
    scores = {}
    for slot in sorted(by_item.keys() | carried.keys()):
        score = np.zeros(len(m), np.int64)
        if slot in carried:
            score[state["places"][carried[slot]]] = state["scores"][carried[slot]]
        for place, part, weight in by_item.get(slot, ()):
            score[place] += weight * part
        scores[slot] = score
    return scores, {"ids": described.column("ids")[0]}


def _tenth(scores: np.ndarray, top: int) -> int:
    """The score that ``top`` documents reach, 0 if there are fewer."""
    return int(np.partition(scores, -top)[-top]) if len(scores) >= top else 0


def _stage(documents: int, terms: int, top: int):
    """One owner's visit: add its contributions and keep what can still come among the best."""
    arrow = to_arrow_schema(STATE)

    def advance(left: pa.Table, right: pa.Table) -> pa.Table:
        scores, _ = _add_contributions(left, right, documents, terms)
        info = {
            slot: (remaining, least)
            for slot, remaining, least in zip(*[left.column(name)[0].as_py() for name in ("info_slots", "remaining", "least")])
        }
        items, places, values, best_items, best_scores = [], [], [], [], []
        for slot, score in scores.items():
            remaining, least = info[slot]
            found = np.flatnonzero(score)
            value = score[found]
            limit = max(least, _tenth(value, top))
            stays = value + remaining >= limit
            found, value = found[stays], value[stays]
            items.append(np.full(len(found), slot, "<i4"))
            places.append(found.astype("<i4"))
            values.append(value.astype("<i8"))
            best = value if len(value) <= top else np.partition(value, -top)[-top:]
            best_items += [slot] * len(best)
            best_scores += best.tolist()
        key = [left.column(name)[0].as_py() for name in ("bundle", "block")]
        packed = [b"".join(a.tobytes() for a in arrays) for arrays in (items, places, values)]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip([*key, *packed, best_items, best_scores], arrow)], schema=arrow)

    return advance


def _selection(documents: int, terms: int, top: int):
    """The last owner's visit: add its contributions and name the block's best documents of each item."""
    arrow = to_arrow_schema(FOUND)

    def select(left: pa.Table, right: pa.Table) -> pa.Table:
        scores, block = _add_contributions(left, right, documents, terms)
        ids = block["ids"].values
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        number = ids.fill_null(0).to_numpy()
        least = dict(zip(*[left.column(name)[0].as_py() for name in ("info_slots", "least")]))
        slots, named, values = [], [], []
        for slot, score in scores.items():
            limit = max(1, least[slot], _tenth(score, top))
            found = np.flatnonzero(score >= limit)
            order = np.lexsort((number[found], missing[found], -score[found]))[:top]
            found = found[order]
            slots += [slot] * len(found)
            named += [None if missing[i] else int(number[i]) for i in found]
            values += score[found].tolist()
        bundle = [left.column("bundle")[0].as_py()] * len(slots)
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip((bundle, slots, named, values), arrow)], schema=arrow)

    return select


def _owned(index: DataFrame, uses: DataFrame, owner: int, broadcast: bool) -> DataFrame:
    """The postings of one owner's terms, a row for each bundle that uses the term."""
    own = uses.where(F.col("owner") == owner).select("term", "bundle", "slots", "weights")
    rows = index.where(F.col("term").isNotNull()).select("block", "term", "places", "counts")
    if broadcast:
        met = rows.join(F.broadcast(own), "term")
    else:
        salted = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"])
    return met.select("bundle", "block", "places", "counts", "slots", "weights")


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    owners: int = OWNERS,
    bundle_size: int = BUNDLE_ITEMS,
    block_docs: int = BLOCK_DOCS,
    block_postings: int = BLOCK_POSTINGS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``top`` documents of each item: ``item_id``, ``rank`` from 1, ``doc_id`` and ``score``."""
    spark = docs.sparkSession
    made: list[str] = []

    def stored(df: DataFrame, label: str) -> DataFrame:
        table, path = materialize(df, label)
        made.append(path)
        return table

    def ranked(df: DataFrame, item_ids: DataFrame) -> DataFrame:
        within = Window.partitionBy("bundle", "slot").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = df.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= top)
        return best.join(item_ids, ["bundle", "slot"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

    try:
        bundled = stored(bundle_items(items, item_key, item_text, bundle_size), "search-items")
        item_ids = bundled.select("bundle", "slot", "item_id")
        pairs = bundled.select("bundle", "slot", F.explode(F.arrays_zip("terms", "counts")).alias("t"))
        item_terms = pairs.select("bundle", "slot", F.col("t.terms").alias("term"), F.col("t.counts").alias("count"))
        index = stored(build_index(docs, _term_bits(item_terms), key, text, block_docs, block_postings), "search-index")
        index_path = made[-1]

        def described() -> DataFrame:
            """The rows that describe blocks; read anew, since Spark does not cogroup a table with itself."""
            return spark.read.schema(INDEX).parquet(index_path).where(F.col("term").isNull())

        size = described().agg(F.sum("size").alias("documents"), F.sum("top").alias("terms")).first()
        documents, terms = size.documents or 0, size.terms or 0
        uses = stored(_weights(index, item_terms, documents), "search-weights")
        by_weight = uses.groupBy("weight").agg(F.sum("df").alias("n"), F.sum(F.octet_length("term") + 12 * F.size("slots") + 40).alias("bytes")).collect()
        limits = owner_limits([(row.weight, row.n) for row in by_weight], owners)
        fits = sum(row.bytes for row in by_weight) <= broadcast_bytes
        if not by_weight:
            empty = described().select(F.lit(0).alias("bundle"), F.lit(0).alias("slot"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("score"))
            out, _ = materialize(ranked(empty.limit(0), item_ids), "search-answers")
            return out
        owner = sum(((F.col("weight") <= limit).cast("int") for limit in limits), F.lit(0))
        uses = uses.withColumn("owner", owner)

        used = uses.select("bundle", "owner", "most", F.explode(F.arrays_zip("slots", "weights")).alias("u"))
        later = [F.sum(F.when(F.col("owner") > k, F.col("u.weights") * F.col("most")).otherwise(0)).alias(f"later{k}") for k in range(owners)]
        bounds = stored(used.groupBy("bundle", F.col("u.slots").alias("slot")).agg(*later), "search-bounds")

        bundles = [row.bundle for row in bounds.select("bundle").distinct().collect()]
        every = F.explode(F.array(*[F.lit(b) for b in bundles])).alias("bundle")
        nothing = F.lit(b"").cast("binary")
        state = described().select(every, "block", nothing.alias("items"), nothing.alias("places"), nothing.alias("scores"))
        thresholds = None
        for k in range(owners):
            known = bounds.select("bundle", "slot", F.col(f"later{k}").alias("later"))
            known = known.withColumn("least", F.lit(0).cast("long")) if thresholds is None else known.join(thresholds, ["bundle", "slot"], "left")
            told = F.struct("slot", "later", F.coalesce("least", F.lit(0).cast("long")).alias("least"))
            info = known.groupBy("bundle").agg(F.collect_list(told).alias("told"))
            info = info.select(
                "bundle", F.col("told.slot").alias("info_slots"), F.col("told.later").alias("remaining"), F.col("told.least").alias("least")
            )
            left = state.join(info, "bundle")
            right = _owned(index, uses, k, fits).unionByName(described().select(every, "block", "ids", "lengths"), allowMissingColumns=True)
            met = left.groupBy("bundle", "block").cogroup(right.groupBy("bundle", "block"))
            if k == owners - 1:
                found = met.applyInArrow(_selection(documents, terms, top), FOUND)
                out, _ = materialize(ranked(found, item_ids), "search-answers")
                return out
            whole = stored(met.applyInArrow(_stage(documents, terms, top), STATE), f"search-state{k}")
            state = whole.select("bundle", "block", "items", "places", "scores")
            best = whole.select("bundle", F.explode(F.arrays_zip("best_items", "best_scores")).alias("b"))
            best = best.select("bundle", F.col("b.best_items").alias("slot"), F.col("b.best_scores").alias("score"))
            within = Window.partitionBy("bundle", "slot").orderBy(F.col("score").desc())
            tenth = best.withColumn("place", F.row_number().over(within)).where(F.col("place") <= top).where(F.col("place") == top)
            thresholds = tenth.select("bundle", "slot", F.col("score").alias("least"))
    finally:
        for path in made:
            discard(spark, path)
    raise AssertionError("There is no owner.")
