"""Fill-in-the-middle documents, made from Arrow list arrays of code points.

Each text is split into its code points as a list array. The lists are flattened with
the index of their parent, every unit gets its ordinal in its text, and from ordinal
and cuts its role: prefix, middle or suffix. The units of each role are filtered,
built into lists again and joined to one piece a text; the pieces and the marks
``<P>``, ``<S>``, ``<M>`` are joined to the output. All of this runs on whole
batches in pyarrow.compute, never on single rows.

Cuts and form come from the SHA-256 of a seed and the document's id. A text that is empty or
holds a mark stays plain, so that ``restore`` gives back every text exactly.

A batch is handled in parts of about ``PART_BYTES`` of text, and a longer text is cut into
segments of that size whose pieces are joined at the end, so memory does not grow with the
length of a text beyond its own copies. Nothing is shuffled.

Defined results: a null text is empty, an empty one plain with no units. A null id is hashed as empty
text. Repeated rows give repeated rows. Columns of the input that are named like an added
one, in any case, are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sparkexp.llm.rows import position_of

# The marks and the shares of the forms.
MARKS = ("<P>", "<S>", "<M>")
PLAIN_PERCENT_FROM = 90
SPM_PERCENT = 20
SEED = 1
PART_BYTES = 250_000
_NOTHING = pa.scalar("", pa.large_string())

ADDED = [
    StructField("n", LongType()),
    StructField("form", StringType()),
    StructField("prefix_chars", LongType()),
    StructField("middle_chars", LongType()),
    StructField("output", StringType()),
]


def split_units(texts: pa.Array) -> pa.Array:
    """The code points of each text, as a list array that shares the texts' bytes."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets[0] == offsets[-1]:
        return pa.LargeListArray.from_arrays(np.zeros(len(texts) + 1, np.int64), pa.array([], pa.large_string()))
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    # A byte that does not continue a code point begins one.
    starts = np.flatnonzero((raw & 0xC0) != 0x80)
    ends = np.append(starts, len(raw)) + offsets[0]
    units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), data)
    return pa.LargeListArray.from_arrays(np.searchsorted(starts, offsets - offsets[0]), units)


def join_units(units: pa.Array, parents: np.ndarray, count: int) -> pa.Array:
    """One text for each of ``count`` parents, from units in the order of their parents."""
    offsets = np.searchsorted(parents, np.arange(count + 1))
    return pc.binary_join(pa.ListArray.from_arrays(offsets.astype(np.int32), units), _NOTHING)


def _pieces(texts: pa.Array, base: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each text whose units are numbered from ``base`` on."""
    lists = split_units(texts)
    parents = pc.list_parent_indices(lists).to_numpy()
    units = pc.list_flatten(lists)
    first = lists.offsets.to_numpy()[:-1]
    ordinals = np.arange(len(units)) - first[parents] + base[parents]
    role = (ordinals >= low[parents]).astype(np.int8) + (ordinals >= high[parents])
    chosen = [role == kind for kind in range(3)]
    return [join_units(units.filter(pa.array(mask)), parents[mask], len(texts)) for mask in chosen]


def _segments(text: str, limit: int) -> list[str]:
    return [text[i : i + limit] for i in range(0, len(text), limit)] or [""]


def transform_batch(texts: pa.Array, low_draw: np.ndarray, high_draw: np.ndarray, form_draw: np.ndarray, order_draw: np.ndarray, limit: int = PART_BYTES) -> list[pa.Array]:
    """The columns of ``ADDED`` for texts without nulls and their four draws."""
    texts = texts.cast(pa.large_string())
    n = pc.utf8_length(texts).to_numpy().astype(np.int64)
    one, two = low_draw % (n + 1), high_draw % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    marked = pc.or_(pc.or_(*[pc.match_substring(texts, m) for m in MARKS[:2]]), pc.match_substring(texts, MARKS[2]))
    plain = (n == 0) | marked.to_numpy(zero_copy_only=False) | (form_draw % 100 >= PLAIN_PERCENT_FROM)
    spm = ~plain & (order_draw % 100 < SPM_PERCENT)

    changed = np.flatnonzero(~plain)
    made = _split_in_parts(texts.take(pa.array(changed)), low[changed], high[changed], limit)
    prefix, middle, suffix = (piece.cast(pa.large_string()) for piece in made)
    lead = pa.array(spm[changed])
    p, s, m = (pa.scalar(mark, pa.large_string()) for mark in MARKS)
    outputs = pc.binary_join_element_wise(
        pc.if_else(lead, s, p), pc.if_else(lead, suffix, prefix), pc.if_else(lead, p, s), pc.if_else(lead, prefix, suffix), m, middle, _NOTHING
    )
    output = pc.replace_with_mask(texts, pa.array(~plain), outputs) if len(changed) else texts
    form = pc.if_else(pa.array(plain), "plain", pc.if_else(pa.array(spm), "spm", "psm"))
    cuts = [pa.array(values, pa.int64(), mask=plain) for values in (low, high - low)]
    return [pa.array(n), form, *cuts, output]


def _split_in_parts(texts: pa.Array, low: np.ndarray, high: np.ndarray, limit: int) -> list[pa.Array]:
    """The pieces of all texts, a bounded number of units at a time."""
    sizes = pc.binary_length(texts).to_numpy()
    out: list[list[pa.Array]] = [[pa.array([], pa.large_string())] for _ in range(3)]
    at = 0
    while at < len(texts):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), limit, "right")))
        if end - at == 1 and sizes[at] > limit:
            segments = _segments(texts[at].as_py(), limit)
            parts = []
            for number, segment in enumerate(segments):
                base = np.array([number * limit])
                parts.append(_pieces(pa.array([segment], pa.large_string()), base, low[at:end], high[at:end]))
            for kind in range(3):
                whole = pa.ListArray.from_arrays(np.array([0, len(parts)], np.int32), pa.concat_arrays([part[kind] for part in parts]))
                out[kind].append(pc.binary_join(whole, _NOTHING))
        else:
            base = np.zeros(end - at, np.int64)
            for kind, piece in enumerate(_pieces(texts.slice(at, end - at), base, low[at:end], high[at:end])):
                out[kind].append(piece)
        at = end
    return [pa.concat_arrays(pieces) for pieces in out]


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None, seed: int = SEED, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Add ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` to each document.

    ``keep`` names the input columns that stay (default: all).
    """
    taken = {field.name.lower() for field in ADDED}
    kept = [
        (i, f)
        for i, f in enumerate(docs.schema.fields)
        if (keep is None or f.name in keep) and f.name.lower() not in taken
    ]
    key_at, text_at = position_of(docs, key), position_of(docs, text)
    rows = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    used = F.coalesce(F.col(f"_{text_at}").cast("string"), F.lit(""))
    numbers = [n.alias(f"_draw{i}") for i, n in enumerate(draws(F.col(f"_{key_at}"), seed))]
    rows = rows.select(*[f"_{i}" for i, _ in kept], used.alias("_used"), *numbers)
    schema = StructType([StructField(f.name, f.dataType, True) for _, f in kept] + ADDED)
    arrow, count = to_arrow_schema(schema), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(count)).to_numpy().astype(np.int64))
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, before + part_bytes, "right")))
                part = batch.slice(at, end - at)
                numbers = [part.column(count + 1 + i).to_numpy() for i in range(4)]
                made = transform_batch(part.column(count), *numbers, part_bytes)
                columns = [part.column(i) for i in range(count)] + made
                columns = [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                at = end

    return rows.mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The text from which an output of this form was made."""
    pieces = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(pieces, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
        .otherwise(output)
    )


def digest(made: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lengths and checksums of each output and of the text restored from it."""
    restored = restore(F.col("output"), F.col("form"))
    return made.select(
        F.col(key).alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )
