"""Stages that prepare training text, each over all that its predecessor kept.

Every stage gets (spark, docs, sf_dir) and returns a table, which is written as
Parquet and read again before the next one. All but the last return the columns of documents,
with the values that came in: a column of the user's whose name an operator uses itself keeps its own.

Null and empty texts have no letters and go in the first stage. Repeated rows and ids are alike to the
second stage, which keeps the row with the smallest id of each group. An empty table stays empty through all stages.
"""

from __future__ import annotations

import math

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkexp.llm import decontaminate, language_id, ngram_join, packing, secret_scan
from sparkexp.llm.ship import shipped
from sparkexp.sources.scratch import discard, materialize

# A text unlike all that was learned has cosines of about 0, give or take 1 in the root of the dimensions.
# Three times that and a little more is what a text must have in common with its language, however many are learned.
MIN_COSINE = 3.2 / math.sqrt(language_id.DIMENSIONS)
VOCABULARY = "byte_bpe_50k.json"
# Workers of earlier stages are still there when packing begins, so each remembers less.
PIECE_BYTES = 16_000_000


@shipped
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or that fit no learned language, go. With nothing to learn from all go."""
    profiles = language_id.train_profiles(docs.where(~language_id.held_out()))
    numbered = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    found = language_id.identify(numbered, profiles, text=f"_{docs.columns.index('text')}")
    clear = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("cosine") >= MIN_COSINE)
    return found.where(clear).select(*numbered.columns).toDF(*docs.columns)


@shipped
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates stays."""
    return ngram_join.keep_one(docs)


@shipped
def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that mostly consist of them go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.decontaminate(docs, items)


@shipped
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secret_scan.redact(docs)


@shipped
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 1,024, one row for each piece."""
    pieces = packing.pack(docs, public_tokenizers.path(VOCABULARY), added_tokens=True, bytes_kept=PIECE_BYTES)
    return packing.digest(pieces)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("secret scan", redact_secrets),
    ("packing", pack_sequences),
]

# Hyperdimensional profiles and a tokenizer's ids have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (name, stage) in enumerate(STAGES, 1):
        docs, path = stage(spark, docs, sf_dir), None
        if number < len(STAGES):
            docs, path = materialize(docs, name.replace(" ", "-"))
        # The stage after has been stored, or, as the last, has stored its pieces.
        if before:
            discard(spark, before)
        before = path
    return docs
