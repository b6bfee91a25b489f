"""Quality rules: counts with fixed limits, and a likelihood ratio of hashed n-grams.

Two multinomials over hashed one- and two-word grams are counted: one over
trusted documents, one over the whole corpus. A document's score is the mean
over its grams of the log of their ratio, so it does not grow with length. It is
kept if it passes the base rules and scores at least ``threshold``. Every document
is judged, by the same rule.

Words are runs without ASCII white space, as written. The trusted documents are
a bounded sample: the ``trusted_documents`` ids with the smallest hash. The corpus
counts cover every document.

Defined results: a null or empty text has no words, fails the base rules and is
not kept. Without trusted documents all scores are 0. A document that is trusted
more than once, or whose id repeats, counts each time it occurs in the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from sparkexp.llm.rows import ROWS_AT_ONCE, add_columns, position_of
from sparkexp.llm.worker import kept

GRAMS = 16_384
TRUSTED_DOCUMENTS = 100_000
THRESHOLD = -0.12
# Grams for each bucket that the trusted counts borrow from the corpus: few trusted documents say little.
PRIOR = 4.0
MIN_WORDS = 50
# Words whose hash a worker remembers.
_WORDS_KEPT = 400_000

# ASCII white space, and the symbols that are counted.
_SPACE, _SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"


class _Hashes(dict):
    """60 bits of the md5 of a word."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = int(hashlib.md5(word).hexdigest()[:15], 16)
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = kept("word hashes", _Hashes)
    if len(known) > _WORDS_KEPT:
        known.clear()
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def gram_buckets(hashes: np.ndarray, grams: int = GRAMS) -> np.ndarray:
    """Buckets of all words and of all pairs of neighbours."""
    small = hashes % 65_521
    return np.concatenate([hashes % grams, (small[:-1] * 31 + small[1:]) % grams])


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(hashes)
    if n < 4:
        return 0
    h = hashes.astype(np.uint64)
    code = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + (h[1:-1] ^ (h[1:-1] >> np.uint64(7))) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[list[bytes], int, int, int]:
    """The words, their code points, the symbols, and the repeated lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text or "") - (len(raw) - len(raw.translate(None, _SPACE)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return words, chars, symbols, len(lines) - len(set(lines))


def count_grams(
    docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, grams: int = GRAMS, trusted_documents: int = TRUSTED_DOCUMENTS
) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each bucket in the whole corpus and in the trusted documents.

    One pass; a task sends one row for each bucket, which Spark adds up. The ids
    of the trusted sample are broadcast; their number is bounded.
    """
    spark = docs.sparkSession
    ids = trusted.select(F.col(trusted.columns[0]).cast("long").alias("id")).where(F.col("id").isNotNull()).distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(trusted_documents).collect()
    shared = spark.sparkContext.broadcast(np.sort(np.array([r.id for r in chosen], np.int64)))
    pair = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))]).select(
        F.col(f"_{position_of(docs, doc_id)}").cast("long").alias("id"), F.col(f"_{position_of(docs, text)}").alias("text")
    )
    schema = StructType([StructField(n, LongType()) for n in ("gram", "corpus", "trusted")])
    arrow = pa.schema([(n, pa.int64()) for n in ("gram", "corpus", "trusted")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, totals = shared.value, np.zeros((2, grams), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                names, found = part.column(0).to_pylist(), ([], [])
                names_at = np.searchsorted(good, [n or 0 for n in names])
                for name, at, value in zip(names, names_at.tolist(), part.column(1).to_pylist()):
                    buckets = gram_buckets(word_hashes((value or "").encode("utf-8", "surrogatepass").split()), grams)
                    found[0].append(buckets)
                    if name is not None and at < len(good) and good[at] == name:
                        found[1].append(buckets)
                for k in range(2):
                    if found[k]:
                        totals[k] += np.bincount(np.concatenate(found[k]), minlength=grams)
        if totals[0].any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(grams)), pa.array(totals[0]), pa.array(totals[1])], schema=arrow)

    rows = pair.mapInArrow(count, schema).groupBy("gram").agg(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted"))
    corpus, target = np.zeros(grams), np.zeros(grams)
    for row in rows.collect():  # one row a bucket
        corpus[row.gram], target[row.gram] = row.corpus, row.trusted
    return corpus, target


def log_ratio(corpus: np.ndarray, trusted: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Log of trusted over corpus probability of each bucket.

    The corpus counts get one gram a bucket; the trusted ones a prior of ``prior``
    grams a bucket that are spread as in the corpus.
    """
    if not trusted.any():
        return np.zeros(len(corpus))
    raw = (corpus + 1) / (corpus.sum() + len(corpus))
    borrowed = prior * len(corpus)
    return np.log((trusted + borrowed * raw) / (trusted.sum() + borrowed)) - np.log(raw)


def judge(
    docs: DataFrame, ratio: np.ndarray, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None
) -> DataFrame:
    """Add the base counts, ``llr``, ``base_failed`` and ``kept`` to each document. Row by row, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    counted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    added = [StructField(n, LongType()) for n in counted]
    added += [StructField("llr", DoubleType()), StructField("base_failed", BooleanType()), StructField("kept", BooleanType())]

    def make():
        weights = shared.value

        def one(value: str | None) -> tuple:
            words, chars, symbols, lines = base_counts(value)
            hashes = word_hashes(words)
            n, repeats = len(words), repeated_words(hashes)
            buckets = gram_buckets(hashes, len(weights))
            llr = float(weights[buckets].mean()) if n else 0.0
            failed = n < MIN_WORDS or 100 * repeats > 50 * n
            return n, chars, symbols, lines, repeats, llr, failed, not failed and llr >= threshold

        return lambda columns: [list(v) for v in zip(*map(one, columns[0]))]

    return add_columns(docs, [text], added, make, keep)
