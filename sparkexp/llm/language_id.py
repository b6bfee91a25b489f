"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from a seed and its code
point. A trigram is its letters' vectors, rotated by place and multiplied. A
text is the sum of its trigrams, a language the sum of its texts, and a text
belongs to the language whose sum it makes the smallest angle with.

Trigrams run over lower-case letters; every other character, and either end of
the text, is a single space. Whole texts are read.

Defined results: a text that is null or has no letter is ``und`` with score 0.
Rows without a language train nothing. With no training rows at all every text
is ``und``. Equal cosines go to the language first in order. Repeated rows are
answered one by one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from sparkexp.llm.rows import ROWS_AT_ONCE, add_columns, position_of
from sparkexp.llm.worker import kept

DIMENSIONS = 1024
SEED = 20
UNKNOWN = "und"
# Languages whose profiles the driver can hold; more is refused rather than cut.
MAX_LANGUAGES = 5000
# Cosines are compared after multiplication by this, which spreads the score over 0 to 1.
SHARPNESS = 20.0
# Distinct trigrams whose vectors a worker keeps.
_KEPT_GRAMS = 40_000
_GRAMS_AT_ONCE = 4096

_SPACE = 32


class Encoder:
    """Trigram vectors of a seed, made when first needed."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED) -> None:
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.grams: dict[int, int] = {}
        # Memory is taken as rows are filled; the table is never copied.
        self.vectors = np.empty((_KEPT_GRAMS, dimensions), np.int8)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions, dtype=np.int8)
            self.letters[code] = bits * 2 - 1
        return self.letters[code]

    def _gram(self, gram: int) -> np.ndarray:
        first, second, third = gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF
        return np.roll(self._letter(first), 2) * np.roll(self._letter(second), 1) * self._letter(third)

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """Row numbers of ``vectors`` for the distinct ``grams``, of which there are ``_GRAMS_AT_ONCE`` at most."""
        wanted = grams.tolist()
        new = [g for g in wanted if g not in self.grams]
        if new:
            if len(self.grams) + len(new) > _KEPT_GRAMS:
                self.grams, new = {}, wanted
            for gram in new:
                self.vectors[len(self.grams)] = self._gram(gram)
                self.grams[gram] = len(self.grams)
        return np.fromiter((self.grams[g] for g in wanted), np.int64, len(wanted))


def _encoder(dimensions: int, seed: int) -> Encoder:
    return kept(("letters", dimensions, seed), lambda: Encoder(dimensions, seed))


_is_letter = np.zeros(0x110000, np.int8)  # 0: not looked up, 1: a letter, -1: none


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a text and their counts."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    kind = _is_letter[codes]
    if not kind.all():
        for code in np.unique(codes[kind == 0]).tolist():
            _is_letter[code] = 1 if chr(code).isalpha() else -1
        kind = _is_letter[codes]
    letter = kind == 1
    codes = np.where(letter, codes, _SPACE)
    codes = codes[letter | np.concatenate([[True], letter[:-1]])]
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)


def _bundles(encoder: Encoder, texts: list[str | None]) -> np.ndarray:
    """One sum of trigram vectors for each text."""
    found = [trigrams(t) for t in texts]
    every = np.concatenate([g for g, _ in found]) if found else np.empty(0, np.int64)
    out = np.zeros((len(texts), encoder.dimensions), np.float32)
    if not len(every):
        return out
    distinct, place = np.unique(every, return_inverse=True)
    row = np.repeat(np.arange(len(texts)), [len(g) for g, _ in found])
    count = np.concatenate([c for _, c in found]).astype(np.float32)
    step = _GRAMS_AT_ONCE
    for start in range(0, len(distinct), step):
        part = distinct[start : start + step]
        here = (place >= start) & (place < start + step)
        table = np.zeros((len(texts), len(part)), np.float32)
        table[row[here], place[here] - start] = count[here]
        rows = encoder.rows(part)
        out += table @ encoder.vectors[rows].astype(np.float32)
    return out


def train_profiles(
    docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED
) -> dict[str, np.ndarray]:
    """The sum of all rows' trigram vectors by language.

    Every task sends one row for each language it saw; those are added up by
    Spark, so the driver gets one vector a language.
    """
    pair = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))]).select(
        F.col(f"_{position_of(docs, lang)}").cast("string").alias("lang"), F.col(f"_{position_of(docs, text)}").alias("text")
    )
    schema = StructType([StructField("lang", StringType()), StructField("place", LongType()), StructField("value", LongType())])
    arrow = pa.schema([("lang", pa.string()), ("place", pa.int64()), ("value", pa.int64())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = _encoder(dimensions, seed), {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                by_lang: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
                for name, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by_lang.setdefault(name, []).append(trigrams(value))
                for name, found in by_lang.items():
                    grams, place = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                    if not len(grams):
                        continue
                    count = np.bincount(place, np.concatenate([c for _, c in found]), len(grams))
                    vector = np.zeros(dimensions)
                    for at in range(0, len(grams), _GRAMS_AT_ONCE):
                        rows = encoder.rows(grams[at : at + _GRAMS_AT_ONCE])
                        vector += count[at : at + _GRAMS_AT_ONCE].astype(np.float32) @ encoder.vectors[rows].astype(np.float32)
                    total[name] = total.get(name, 0) + vector
        for name, vector in total.items():
            whole = np.rint(vector).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), pa.array(np.arange(dimensions)), pa.array(whole)], schema=arrow)

    summed = (
        pair.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .mapInArrow(sums, schema)
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
    )
    # One row a language; every task sends all of a vector's places.
    whole = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).value.alias("vector"))
    rows = whole.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"There are more than {MAX_LANGUAGES} languages to learn.")
    return {row.lang: np.array(row.vector, float) for row in sorted(rows)}


def identify(
    docs: DataFrame,
    profiles: dict[str, np.ndarray],
    text: str = "text",
    keep: list[str] | None = None,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``cosine`` to each document. Row by row, without a shuffle.

    The score is the share of the chosen language when the cosines are sharpened
    and normalised, so it is 1/languages for a text that fits all alike. The cosine with the chosen language
    does not depend on the others: a text that shares no trigrams with it has about 0, give or take
    one part in the root of the dimensions. It is 0 for ``und``.
    """
    names = list(profiles)
    matrix = np.stack(list(profiles.values())) if names else np.zeros((1, dimensions))
    matrix = (matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)).astype(np.float32).T
    shared = docs.sparkSession.sparkContext.broadcast(matrix)

    def make():
        encoder = _encoder(dimensions, seed)

        def some(texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
            sums = _bundles(encoder, texts)
            length = np.linalg.norm(sums, axis=1)
            cosine = (sums @ shared.value).astype(np.float64) / np.maximum(length, 1e-12)[:, None]
            best = cosine.argmax(axis=1)
            odds = np.exp(SHARPNESS * (cosine - cosine.max(axis=1, keepdims=True)))
            share = odds.max(axis=1) / odds.sum(axis=1)
            lettered = [n > 0 and bool(names) for n in length.tolist()]
            return (
                [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered)],
                [s if ok else 0.0 for s, ok in zip(share.tolist(), lettered)],
                [c if ok else 0.0 for c, ok in zip(cosine.max(axis=1).tolist(), lettered)],
            )

        def work(columns):
            out: list[list] = [[], [], []]
            for start in range(0, len(columns[0]), 64):
                for column, part in zip(out, some(columns[0][start : start + 64])):
                    column += part
            return out

        return work

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("cosine", DoubleType())]
    return add_columns(docs, [text], added, make, keep)


def held_out(doc_id: str = "doc_id") -> Column:
    """A fixed third of the documents that no profile learns from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def held_out_by_crc(doc_id: int) -> bool:
    """The same for one id."""
    return zlib.crc32(str(doc_id).encode()) % 3 == 1
