"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case.
The items become one automaton of words. Each text is streamed through it once,
keeping the longest suffix read so far that occurs in an item. A match of at
least ``window`` words is a span; items shorter than that count when they
occur whole.

Defined results: a null or empty text has no words and no spans. Items without
words match nothing. Items with equal ids are one item; a null id counts as the
empty string. Repeated rows are answered one by one. Without items nothing is hit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from sparkexp.llm.rows import add_columns, position_of, words_of
from sparkexp.llm.worker import kept

WINDOW = 10
# Text of items in one automaton. The benchmark as a whole is collected and broadcast, so it must fit the driver.
BLOCK_BYTES = 4_000_000
# A document of which more than this is hit is left out altogether.
MAX_COVERAGE = 0.5

# The words of ``words_of`` in a text whose letters are still as written.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SPAN = ArrayType(StructType([StructField("first", IntegerType()), StructField("end", IntegerType())]))


class ItemAutomaton:
    """All word sequences inside a set of items, and which items hold them."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW) -> None:
        self.window = window
        self.steps: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        paths: list[tuple[str, list[int]]] = []
        for name, text in items:
            state, path = 0, []
            for word in words_of(text):
                state = self._extend(state, word)
                path.append(state)
            paths.append((name, path))
        # The state of the last ``window`` words of a match, and the items with those words.
        self.top = self._tops()
        self.holders: dict[int, set[str]] = {}
        self.short: dict[int, set[str]] = {}
        for name, path in paths:
            if 0 < len(path) < window:
                self.short.setdefault(path[-1], set()).add(name)
            for state in path[window - 1 :]:
                self.holders.setdefault(self.top[state], set()).add(name)
        self.near = self._near()

    def _new(self, length: int, steps: dict[bytes, int], link: int) -> int:
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, before: int, word: bytes, state: int) -> int:
        """Give the shorter sequences of ``state`` that follow ``before`` a state of their own."""
        clone = self._new(self.length[before] + 1, dict(self.steps[state]), self.link[state])
        self.link[state] = clone
        while before != -1 and self.steps[before].get(word) == state:
            self.steps[before][word] = clone
            before = self.link[before]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        there = self.steps[last].get(word)
        if there is not None:
            return there if self.length[there] == self.length[last] + 1 else self._split(last, word, there)
        new = self._new(self.length[last] + 1, {}, 0)
        while last != -1 and word not in self.steps[last]:
            self.steps[last][word] = new
            last = self.link[last]
        if last != -1:
            there = self.steps[last][word]
            exact = self.length[there] == self.length[last] + 1
            self.link[new] = there if exact else self._split(last, word, there)
        return new

    def _by_length(self) -> list[int]:
        return sorted(range(1, len(self.length)), key=self.length.__getitem__)

    def _tops(self) -> dict[int, int]:
        top: dict[int, int] = {}
        for state in self._by_length():
            if self.length[state] >= self.window:
                above = self.link[state]
                top[state] = state if self.length[above] < self.window else top[above]
        return top

    def _near(self) -> list[int]:
        """The nearest state on the way to the root where a short item ends."""
        near = [0] * len(self.length)
        if self.short:
            for state in self._by_length():
                near[state] = state if state in self.short else near[self.link[state]]
        return near

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """For each end of a match: its first word, its last word, and the items."""
        steps, link, length, window = self.steps, self.link, self.length, self.window
        near = self.near if self.short else None
        root, state, size = steps[0], 0, 0
        for i, word in enumerate(words):
            there = steps[state].get(word)
            if there is not None:
                size += 1
            else:
                while there is None and state:
                    state = link[state]
                    there = steps[state].get(word)
                size = length[state] + 1
                if there is None:
                    there = size = 0
            state = there
            if size >= window:
                yield i - size + 1, i, self.holders[self.top[state]]
            if near and state:
                end = near[state if length[state] <= size else link[state]]
                while end:
                    yield i - length[end] + 1, i, self.short[end]
                    end = near[link[end]]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans (first word, end exclusive) and the items that occur."""
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        for first, last, holders in self.matches(words):
            while spans and spans[-1][1] >= first:
                first = min(first, spans.pop()[0])
            spans.append((first, last + 1))
            if not holders <= names:
                names |= holders
        return spans, names


def _automaton(items: list[tuple[str, str | None]], window: int) -> ItemAutomaton:
    """The worker's automaton of these items; it holds on to them, so that no others can have their address."""
    return kept(("automaton", id(items), window), lambda: (ItemAutomaton(items, window), items))[0]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and out[-1][1] >= first:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _item_blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items in parts of about ``block_bytes``, so that one automaton is bounded; all parts together are not."""
    named = items.toDF(*[f"_{i}" for i in range(len(items.columns))]).select(
        F.coalesce(F.col(f"_{position_of(items, item_id)}").cast("string"), F.lit("")).alias("name"),
        F.col(f"_{position_of(items, item_text)}").alias("text"),
    )
    rows = named.where(F.col("text").isNotNull()).distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block) if blocks > 1 else rows
        yield [(row.name, row.text) for row in part.select(F.col("name"), F.col("text")).collect()]


def find_spans(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
    cut: list[str] | None = None,
) -> DataFrame:
    """Add ``n_words``, ``spans`` of word numbers (end exclusive) and ``items`` to each document.

    With ``cut`` (the text column, or it and the column of its length) the same pass also cuts the spans out of the text.

    Items beyond ``block_bytes`` of text are taken in blocks, one pass over the
    texts each; a document never leaves its partition.
    """
    added = [
        StructField("n_words", LongType()),
        StructField("spans", _SPAN),
        StructField("items", ArrayType(StringType())),
    ]

    def one_block(frame: DataFrame, block: list[tuple[str, str]], first: bool, last: bool) -> DataFrame:
        shared = frame.sparkSession.sparkContext.broadcast(block)
        changed = [f for f in frame.schema.fields if last and cut and f.name in cut]
        lengths = [name for name in cut or [] if last and name != text]
        uses = [text, *([] if first else ["spans", "items"]), *lengths]

        def make():
            automaton = _automaton(shared.value, window)

            def work(columns):
                texts = columns[0]
                before = [[[]] * len(texts)] * 2 if first else columns[1:3]
                counts, spans, names = [], [], []
                for value, old_spans, old_names in zip(texts, *before):
                    words = words_of(value)
                    found, items_found = automaton.scan(words)
                    counts.append(len(words))
                    if old_spans:
                        found = _merge(found + [(s["first"], s["end"]) for s in old_spans])
                    spans.append([{"first": a, "end": b} for a, b in found])
                    names.append(sorted(items_found.union(old_names)))
                if not changed:
                    return [counts, spans, names]
                clean = [_without(t, [(s["first"], s["end"]) for s in found]) if found else t for t, found in zip(texts, spans)]
                numbers = [len(t) if found else n for t, found, n in zip(clean, spans, columns[-1])]
                return [counts, spans, names, *[clean if f.name == text else numbers for f in changed]]

            return work

        passed = list(keep) if keep is not None else list(frame.columns)
        return add_columns(frame, uses, [*added, *changed], make, keep=passed if last else [*passed, text])

    blocks = list(_item_blocks(items, item_id, item_text, block_bytes))
    numbered = list(enumerate(blocks))
    return reduce(lambda frame, nb: one_block(frame, nb[1], nb[0] == 0, nb[0] == len(blocks) - 1), numbered, docs)


def _without(value: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans' words and what stands between them."""
    raw = value.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw)]
    out, at = [], 0
    for first, end in spans:
        out.append(raw[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    n_chars: str | None = "n_chars",
    max_coverage: float = MAX_COVERAGE,
    **options,
) -> DataFrame:
    """The documents without benchmark spans, with their own columns.

    Spans are cut out of the text; a document of which more than
    ``max_coverage`` of the words is hit goes altogether. Untouched documents
    stay as they are, null texts too. ``n_chars`` follows a changed text.
    """
    # Numbered, so that no column of the user's is taken for one that the search adds.
    numbered = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    body = f"_{position_of(docs, text)}"
    length = f"_{position_of(docs, n_chars)}" if n_chars in docs.columns else None
    found = find_spans(numbered, items, text=body, cut=[body, length] if length else [body], **options)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s.end - s.first)
    kept = found.where(hit <= F.lit(max_coverage) * F.col("n_words"))
    return kept.select(*numbered.columns).toDF(*docs.columns)


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts and the hash of the items' ids, one row for each document."""

    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s.end - s.first)
    return found.select(
        F.col(doc_id).alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def items_hash(names: list[str]) -> str:
    """What ``items_sha256`` holds for these item ids."""
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
