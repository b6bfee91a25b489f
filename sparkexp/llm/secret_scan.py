"""Secret scan that links the parts of a credential.

Strong patterns count alone. Weak parts (an account name, an opaque key, an
endpoint) are common in clean text, so they count only when the part that
completes them lies in the same scope: at most ``scope`` characters away.
The parts of a text are joined as intervals: sorted by place, each weak part
looks for the nearest complement with a binary search, so a text with many
parts costs no pairs.

An opaque key is a run of 32 or more base64 characters with a digit, a small and a
capital letter, and up to two '=' behind it; an '=' before it is no part of it.

Defined results: a null text is empty and has no spans. Spans of one kind never
overlap; spans of different kinds may. Repeated rows are scanned one by one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from sparkexp.llm.rows import add_columns
from sparkexp.llm.worker import release

SCOPE = 200
# The kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "account", "opaque", "endpoint")
BASE = KINDS[:3]

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ACCOUNT = re.compile(
    r"""(?<![a-z0-9])(?:user(?:_?name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[a-z0-9_.@+-]{3,}""", re.I | re.A
)
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=_-])")
_ENDPOINT = re.compile(r"""[a-z][a-z0-9+.]{1,15}://[^\s"'<>]{4,}""", re.A)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the strong patterns, leftmost and non-overlapping within a kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


class _Places:
    """Sorted intervals that answer whether one of them lies near another interval."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.spans = sorted(spans)
        self.starts = [s for s, _ in self.spans]
        self.reach: list[int] = []
        for _, end in self.spans:
            self.reach.append(max(end, self.reach[-1] if self.reach else 0))

    def near(self, start: int, end: int, scope: int) -> bool:
        """Does an interval come within ``scope`` of [start, end)?"""
        last = bisect_left(self.starts, end + scope) - 1
        return last >= 0 and self.reach[last] >= start - scope


def linked_spans(text: str, base: list[Span], scope: int = SCOPE) -> list[Span]:
    """Weak parts whose complement lies in scope."""
    accounts = [("account", m.start(), m.end()) for m in _ACCOUNT.finditer(text)] if "=" in text or ":" in text else []
    strong = [(s, e) for kind, s, e in base if kind in ("assign", "hex")]
    keys = [(s, e) for kind, s, e in base if kind == "access"]
    if not (accounts or strong or keys):
        return []
    taken = _Places([(s, e) for _, s, e in base])
    opaque = [("opaque", m.start(), m.end()) for m in _OPAQUE.finditer(text)]
    opaque = [x for x in opaque if not taken.near(x[1] + 1, x[2] - 1, 0)]
    names = _Places(keys + [(s, e) for _, s, e in accounts])
    secrets = _Places(strong + [(s, e) for _, s, e in opaque])
    found = [x for x in accounts if secrets.near(x[1], x[2], scope)]
    found += [x for x in opaque if names.near(x[1], x[2], scope)]
    known = _Places([(s, e) for _, s, e in found] + strong)
    for m in _ENDPOINT.finditer(text) if "://" in text else ():
        start, end = m.span()
        if names.near(start, end, scope) and known.near(start, end, scope):
            found.append(("endpoint", start, end))
    return found


def ordered(spans: list[Span]) -> list[Span]:
    """By start, then by kind as listed."""
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan(text: str | None, scope: int = SCOPE) -> list[Span]:
    """All spans of a text, in order, in code points, end exclusive."""
    base = base_spans(text or "")
    return ordered(base + linked_spans(text or "", base, scope))


def joined(spans: list[Span]) -> str:
    """``kind:start:end`` of each span, comma-joined."""
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def base_hash(spans: list[Span]) -> str:
    """Hash over the strong spans alone."""
    return hashlib.sha256(joined([x for x in spans if x[0] in BASE]).encode()).hexdigest()


_SPANS = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
)


def find_secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE, keep: list[str] | None = None) -> DataFrame:
    """Add ``secrets``, the ordered spans of each document. Row by row, without a shuffle."""

    def make():
        return lambda columns: [
            [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t, scope)] for t in columns[0]]
        ]

    return add_columns(docs, [text], [StructField("secrets", _SPANS)], make, keep)


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Counts, the hash of the strong spans and all spans, one row for each document."""
    kinds = [StructField(f"n_{kind}", LongType()) for kind in BASE]
    added = [*kinds, StructField("base_sha256", StringType()), StructField("spans", StringType())]

    def make():
        def work(columns):
            found = [scan(t, scope) for t in columns[0]]
            counts = [[sum(x[0] == kind for x in spans) for spans in found] for kind in BASE]
            return [*counts, [base_hash(spans) for spans in found], [joined(spans) for spans in found]]

        return work

    found = add_columns(docs, [text], added, make, keep=[doc_id])
    return found.withColumnRenamed(doc_id, "doc_id")


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """The documents with each run of overlapping secret spans replaced by ``mask``.

    Documents without a span stay as they are. ``n_chars`` follows a changed text.
    """
    fields = [f for f in docs.schema.fields if f.name in (text, n_chars)]

    def clean(value: str | None) -> str | None:
        out, at = [], 0
        for _, start, end in scan(value, scope):
            if start >= at:
                out += [value[at:start], mask]
            at = max(at, end)
        return "".join([*out, value[at:]]) if out else value

    def make():
        release()

        def work(columns):
            texts = [clean(t) for t in columns[0]]
            if len(fields) == 1:
                return [texts]
            counts = [n if new == old else len(new) for new, old, n in zip(texts, *columns)]
            return [texts if f.name == text else counts for f in fields]

        return work

    uses = [text] + ([n_chars] if len(fields) == 2 else [])
    return add_columns(docs, uses, fields, make).select(*docs.columns)
