"""Two-pass external shuffle of a table into shards of equal row counts.

Pass one scatters rows into buckets by a seeded hash of the whole row; the number of
buckets follows the table's bytes, so a bucket fits in memory. Pass two loads one bucket
at a time, puts its rows in the order of their hashes, and shuffles them by Fisher and
Yates with a seed of its own. The buckets, one after another, are the shuffled table; it is cut into
shards whose counts differ by one at most (law ``rows``). Each bucket is written by one task.

Where a row goes depends on its content, the seed and the number of buckets alone, never on the input's
layout, so it does not matter how often Spark computes the input or in which order its rows come. A key
with very many rows is spread by their other columns. Rows that are equal in every column and so many that
they would fill a bucket are counted, and the copies are numbered and scattered by hash and number.
What was written is compared with what was counted; a difference, as from an input that is computed
differently each time, raises.

Defined results: a null text has no bytes and checksum 0. Repeated rows are kept
and placed one by one. An empty table has no shards. Null keys are a key. Columns that Spark cannot hash
(maps) do not take part in the hash; with such a column equal rows are not spread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from sparkexp.llm.rows import position_of
from sparkexp.operators.prefix import running_totals
from sparkexp.sources.scratch import materialize, scratch_path

SHARDS = 40
SEED = 7
BUCKET_BYTES = 16_000_000
ROW_BYTES = 16
# Copies of one row that a task makes from its count at a time.
COPIES_AT_ONCE = 10_000


def fisher_yates(count: int, seed: list[int]) -> list[int]:
    """A uniformly random order of 0 to count - 1."""
    order = list(range(count))
    if count > 1:
        draws = np.random.default_rng(seed).integers(0, np.arange(count, 1, -1)).tolist()
        for i, j in zip(range(count - 1, 0, -1), draws):
            order[i], order[j] = order[j], order[i]
    return order


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def shuffle_into_shards(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> DataFrame:
    """Write the shuffled shards below ``path`` (one folder each) and return them as a table.

    The table has the input's columns and ``shard`` and ``slot`` (the place in
    the shard, from 0); input columns of those names are replaced.
    """
    spark = docs.sparkSession
    fields = [f for f in docs.schema.fields if f.name.lower() not in ("shard", "slot")]
    places = [i for i, f in enumerate(docs.schema.fields) if f.name.lower() not in ("shard", "slot")]
    position_of(docs, key)
    size = _size(F.col(f"_{position_of(docs, text)}"))
    rows = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    own = [f"_{i}" for i in places]
    hashable = [name for name, field in zip(own, fields) if "map<" not in field.dataType.simpleString()]
    row_hash = F.xxhash64(F.lit(seed), *[c for name in hashable for c in (F.col(name), F.col(name).isNull())])

    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    buckets = max(1, -(-totals.bytes // bucket_bytes))
    hashed = rows.select(row_hash.alias("_hash"), *own)
    scattered = _scatter(hashed, own, buckets, max(2, totals.n // buckets), seed, len(hashable) == len(own))

    counts = scattered.groupBy("bucket").count().withColumn("part", F.floor(F.col("bucket") / 4096))
    summed = running_totals(counts, bucket="part", order="bucket", sums=["count"])
    first = summed.select("bucket", (F.col("cum_count") - F.col("count")).alias("first"))
    # Join and grouping share one shuffle by bucket.
    scattered = scattered.join(first, "bucket")
    rows_total = totals.n
    schema = StructType(
        [StructField(f"_{k}", f.dataType, True) for k, f in enumerate(fields)]
        + [StructField("shard", IntegerType()), StructField("slot", LongType())]
    )
    arrow = to_arrow_schema(schema)

    def one_bucket(table: pa.Table) -> pa.Table:
        number, start = table.column("bucket")[0].as_py(), table.column("first")[0].as_py()
        # Rows of equal hash are equal, so their order does not matter.
        alike = np.argsort(table.column("_hash").to_numpy(), kind="stable")
        order = alike[fisher_yates(len(alike), [seed, number])]
        place = start + np.arange(len(order))
        # Shard s holds the places from ceil(s * rows / shards) on, so counts differ by one at most.
        shard = place * shards // rows_total
        slot = place - -(-shard * rows_total // shards)
        taken = table.select(own).take(pa.array(order, pa.int64()))
        columns = [column.cast(f.type) for column, f in zip(taken.columns, arrow)]
        columns += [pa.array(shard.astype(np.int32)), pa.array(slot)]
        return pa.Table.from_arrays(columns, schema=arrow)

    done = scattered.groupBy("bucket").applyInArrow(one_bucket, schema)
    path = path or scratch_path(spark, "shards")
    done.toDF(*[f.name for f in fields], "shard", "slot").write.partitionBy("shard").parquet(path)
    kept = StructType([StructField(f.name, f.dataType, True) for f in fields] + [StructField("slot", LongType()), StructField("shard", IntegerType())])
    written = spark.read.schema(kept).parquet(path)
    _verify(written, rows_total, shards)
    return written


def _scatter(hashed: DataFrame, own: list[str], buckets: int, few: int, seed: int, spread: bool) -> DataFrame:
    """The rows with their bucket. Equal rows, more than ``few``, are numbered."""
    plain = F.pmod(F.col("_hash"), F.lit(buckets)).alias("bucket")
    heavy = hashed.groupBy("_hash").count().where(F.col("count") > few).select("_hash")
    if not spread:
        return hashed.select(plain, "_hash", *own)
    # Fewer than the buckets. As a stored table Spark knows its size and broadcasts it only if it is small.
    heavy, _ = materialize(heavy, "heavy-rows")
    if heavy.isEmpty():
        return hashed.select(plain, "_hash", *own)
    chunks = hashed.join(heavy, "_hash", "left_semi").groupBy("_hash", *own).agg(F.count(F.lit(1)).alias("_n"))
    at_once = F.lit(COPIES_AT_ONCE)
    chunks = chunks.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / at_once).cast("long"))))
    dealt = chunks.repartition("_hash", "_chunk")
    last = F.least(F.col("_n") - F.col("_chunk") * at_once, at_once) - 1
    copies = dealt.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    copy = F.col("_copy") + F.col("_chunk") * at_once
    numbered = F.pmod(F.xxhash64(F.lit(seed), F.col("_hash"), copy), F.lit(buckets)).alias("bucket")
    rest = hashed.join(heavy, "_hash", "left_anti").select(plain, "_hash", *own)
    return rest.unionByName(copies.select(numbered, "_hash", *own))


def _verify(written: DataFrame, rows: int, shards: int) -> None:
    """Raise unless every shard holds the places it must, each once."""
    found = written.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"), F.max("slot").alias("last"), F.sum("slot").alias("sum")
    )
    got = {row.shard: (row.n, row.last, row.sum) for row in found.collect()}
    wanted = {}
    for shard in range(shards):
        n = -(-(shard + 1) * rows // shards) - -(-shard * rows // shards)
        if n:
            wanted[shard] = (n, n - 1, n * (n - 1) // 2)
    if got != wanted:
        raise RuntimeError("The rows written are not those counted: the input is computed differently each time. Store it first.")


def digest(shards: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Where each row lies, with its size and the checksum of its text."""
    return shards.select(
        F.col(key).alias("doc_id"),
        _size(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
