"""Main text of HTML pages by classifying flat text blocks.

A page is cut into blocks at block-level tags. Each block has its number of words
and link density, those of the blocks before and after it, whether it is a paragraph or a heading, and
whether it stands in an article, in page furniture, or on a page that has an article at all. A small
decision tree says which blocks are main text. It is trained on the blocks that the parser finds in the
labelled pages of ``LAYOUTS``, sources of several layouts with and without an article element.

An article element inside an element with a layout's class word (sidebar, menu) or a form is not
furniture for that; inside comments, teaser lists, ``nav``, ``aside`` and the like it is. A
``main`` element never is. No block of an article is dropped for its links alone.

References are decoded, white space within a block becomes one space, and the
kept blocks are joined in page order with an empty line between.

Defined results: null or empty HTML gives an empty text, and so does a page
without main text. Tags that are not closed last until their parent ends; an open
comment, script, style, iframe, textarea or title lasts to the end. Self-closed svg
and math are empty, and a block tag ends them. Pages are parsed whole; repeated rows
one by one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from sparkexp.llm.rows import add_columns

# Elements by their role.
_RAW = "script|style|iframe|textarea|title"
_DROPPED = frozenset("noscript template svg math object select button canvas".split())
_FOREIGN = frozenset(["svg", "math"])
# Inside svg and math: elements that hold HTML, and HTML elements that end them.
_HOLD_HTML = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
_END_FOREIGN = frozenset("blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 head hr li menu ol p pre table ul".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_CONTAINERS = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form head header html main menu nav ol section "
    "table ul".split()
)
_FURNITURE = frozenset("aside dialog fieldset footer form head menu nav".split())
_FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo "
    "promotion recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "tags toolbar widget".split()
)
# Of these, the words whose element may hold articles that are not the page's: comments and teasers.
_HOLD_ARTICLES = frozenset(
    "ad ads adv advert adverts advertisement comment comments disqus popup promo promotion recommended related reply replies "
    "respond sponsor sponsored widget".split()
)
_LOOSE = frozenset("form fieldset".split())
_PARAGRAPHS, _HEADINGS = frozenset("p pre blockquote".split()), frozenset("h1 h2 h3 h4 h5 h6".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>])(?P<rest>[^>]*)>?"
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"']+)*)>?|<[!?][^>]*>?""",
    re.S | re.I,
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in _RAW.split("|")}
# A slash that ends a tag and is no part of a value without quotes.
_SELF_CLOSED = re.compile(r"""(?:^|["'\s]|[\s"'/][^\s"'=/]+)/\Z""")
_NAMED = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")

# How surely blocks are furniture: not, unless an article is inside, or even then.
NONE, LOOSE, STRICT = 0, 1, 2


@dataclass(frozen=True)
class Place:
    """Where blocks stand: in an article or main element, and in furniture."""

    article: bool = False
    furniture: int = NONE


@dataclass
class Block:
    """Text between two block-level tags, with the innermost of them."""

    text: str
    words: int
    link_words: int
    place: Place
    tag: str = ""


def _furniture(tag: str, attrs: str, in_article: bool) -> int:
    """How surely an element itself is furniture."""
    if tag in _FURNITURE and tag not in _LOOSE or tag == "header" and not in_article:
        return STRICT
    found = LOOSE if tag in _LOOSE else NONE
    if attrs and tag not in ("html", "body"):
        for name, value in _NAMED.findall(attrs):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return STRICT
            if name == "style" and re.search(r"display\s*:\s*none", value):
                return STRICT
            if name == "role" and value in _FURNITURE_ROLES and tag not in ("main", "article"):
                found = max(found, LOOSE if value == "form" else STRICT)
            if name in ("class", "id") and tag != "main":
                for token in value.split():
                    parts = [p for p in _PARTS.split(token) if p]
                    if parts and parts[0] not in ("has", "with", "no"):
                        ends = {parts[0], parts[-1]}
                        # An article is named for what it is about, unless it is a comment or a teaser.
                        if ends & _HOLD_ARTICLES:
                            found = STRICT
                        elif ends & _FURNITURE_WORDS and tag != "article":
                            found = max(found, LOOSE)
    return found


def _place(tag: str, attrs: str, parent: Place) -> Place:
    """The place inside an element, given that of its parent."""
    own = _furniture(tag, attrs, parent.article)
    if tag == "main":
        return Place(True, own)
    if tag == "article":
        return Place(True, max(own, STRICT if parent.furniture == STRICT else NONE))
    return Place(parent.article, max(parent.furniture, own)) if own > parent.furniture else parent


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page, in order."""
    found: list[Block] = []
    stack: list[tuple[str, Place]] = [("", Place())]
    pieces: list[str] = []
    linked: list[str] = []
    links = 0
    inner, local = "", None  # the paragraph, heading or item that is open, and its place if it has one of its own
    dropped: list[str] = []  # the outermost open element without text, and those in it

    def flush() -> None:
        if pieces:
            words = html.unescape("".join(pieces)).split()
            if words:
                in_links = len(html.unescape(" ".join(linked)).split()) if linked else 0
                found.append(Block(" ".join(words), len(words), min(in_links, len(words)), local or stack[-1][1], inner))
        pieces.clear()
        linked.clear()

    page = page or ""
    at = 0
    while m := _TOKEN.search(page, at):
        start, end = m.span()
        if start > at and not dropped:
            pieces.append(page[at:start])
            if links:
                linked.append(page[at:start])
        at = end
        if m["raw"]:
            if not (dropped and dropped[-1] in _FOREIGN and _SELF_CLOSED.search(m["rest"])):
                closed = _RAW_END[m["raw"].lower()].search(page, at)
                at = closed.end() if closed else len(page)
            pieces.append(" ")
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        closing = bool(m["close"])
        if dropped:
            if closing:
                if tag not in _BLOCKS and tag not in _DROPPED and tag not in _HOLD_HTML:
                    continue
                if tag in dropped:
                    while dropped.pop() != tag:
                        pass
                    continue
                if tag in _BLOCKS:  # its element was open before
                    dropped.clear()
            elif tag == "body" or dropped[-1] in _FOREIGN and tag in _END_FOREIGN:
                while dropped and (tag == "body" or dropped[-1] in _FOREIGN):
                    dropped.pop()
            if dropped:
                foreign = tag in _FOREIGN or dropped[-1] in _FOREIGN
                nests = tag in _CONTAINERS or tag in _DROPPED or tag in _HOLD_HTML or tag in _BLOCKS and tag != dropped[-1]
                if not closing and nests and not (foreign and _SELF_CLOSED.search(m["attrs"])):
                    dropped.append(tag)
                continue
        elif tag in _DROPPED and not closing:
            pieces.append(" ")
            if not (tag in _FOREIGN and _SELF_CLOSED.search(m["attrs"])):
                dropped.append(tag)
            continue
        if tag == "a":
            links = max(0, links - 1) if closing else links + 1
        elif tag == "br":
            pieces.append(" ")
        elif tag in _BLOCKS:
            flush()
            links, local, inner = 0, None, "" if closing else tag
            if tag not in _CONTAINERS:
                if not closing and m["attrs"]:
                    local = _place(tag, m["attrs"], stack[-1][1])
            elif closing:
                if any(name == tag for name, _ in stack):
                    while stack[-1][0] != tag:
                        stack.pop()
                    stack.pop()
            else:
                if tag == "body":
                    del stack[1:]
                stack.append((tag, _place(tag, m["attrs"], stack[-1][1])))
    if at < len(page) and not dropped:
        pieces.append(page[at:])
        if links:
            linked.append(page[at:])
    flush()
    return found


# The features of a block; those from PLACES on say where it stands.
FEATURES = (
    "words before", "link density before", "words", "link density", "words after", "link density after", "paragraph", "heading",
    "in an article", "in furniture", "page with an article",
)
PLACES = FEATURES.index("in an article")


def features(blocks: list[Block]) -> np.ndarray:
    """A row for each block, as named in ``FEATURES``."""
    words = np.array([0, *(b.words for b in blocks), 0], np.float64)
    links = np.array([0, *(b.link_words for b in blocks), 0], np.float64)
    density = links / np.maximum(words, 1)
    article = np.array([b.place.article for b in blocks], bool)
    furniture = np.array([b.place.furniture > NONE for b in blocks], bool)
    has_article = np.full(len(blocks), bool((article & ~furniture).any()))
    kinds = [[b.tag in kind for b in blocks] for kind in (_PARAGRAPHS, _HEADINGS)]
    return np.column_stack(
        [words[:-2], density[:-2], words[1:-1], density[1:-1], words[2:], density[2:], *kinds, article, furniture, has_article]
    )


# The labelled pages. [n] stands for n words of main text, (n) for n other words, {n} for a link of n words, {+n}
# for one that is main text, and two numbers n-m for a number drawn from n to m.
LAYOUTS = """
<header><a>{1-3}</a></header><nav><ul><li>{1-2}<li>{1}<li>{1-3}</ul></nav><div class=ad>(3-40)</div><article><h1>[3-14]</h1><p>[20-160]<p>[1-12]<p>[30-90]<p>{+5-30}<p>[40-200]</article><footer>(4-30)</footer>
<div><ul><li>{1}<li>{1-2}<li>{1-2}<li>{1-3}</ul></div><div><h1>[3-12]</h1><p>[12-60]<p>[8-40]<p>[25-120]<p>[6-30] {+1-3}</div><div>{2-60}</div><div>(3-9)</div>
<table><tr><td>{1-2}<td>{1-2}<td>{1}</tr></table><table><tr><td><h2>[2-9]</h2><p>[30-150]<p>[20-90]<p>[15-60]</td></tr></table><p>(2-8) {1-2}</p>
<div class="menu top">{1} {1} {2}</div><div class=content><h1>[3-10]</h1><p>[10-30]<p>[10-40]<p>[20-100]<ul><li>[4-20]<li>[5-25]<li>[3-18]</ul><p>[20-80]</div><div class=related><h3>(1-3)</h3><p>(20-40) {3}<p>(15-30)</div><footer><p>(5-40)</footer>
<main><h1>[2-12]</h1><div>[20-120]</div><div>[30-90]</div><blockquote>[8-40]</blockquote><p>{+2-20}<div class=share>{1}{1}</div><section id=comments><article><p>(10-60)</article><article><p>(8-40)</article></section></main><aside><h3>(1-3)</h3><p>(20-50)</aside>
<div class=page><div class="sidebar-right"><main><article><h1>[3-9]</h1><p>[15-60]<p>[25-90]</article></main></div></div><div>(10-35)</div><p>(12-40)
<form><div class="has-menu nav"><article><h2>[2-8]</h2><p>[20-70]<pre>[5-40]</pre><p>[10-60]</article></div><p>(5-30)</form><div>{1-3}</div>
<div>{1-2}</div><div>{2-3}</div><h1>[3-10]</h1><p>[15-30]<p>[10-20]<div>(2-6)</div><div>{1} {1}</div>
<div><a>{2}</a> (1-3)</div><div>(2-5)</div><p>[30-90]<p>[25-120]<p>[40-150] {+2}<h2>[2-6]</h2><p>[20-60]<div>{4-60}</div><div>{3-40}</div><div>{4-7}</div>
<div>{1} {2} {10-80}</div><ul><li>{3-9}<li>{4-10}<li>{3-8}<li>{5-30}</ul><ul><li>{1}<li>{1}</ul><p>(3-9)</p><div>(1-6)</div>
<header><nav>{1}{1}</nav><h1>(2-4)</h1></header><div class="cookie-notice"><p>(15-60)</div><article><header><h1>[3-12]</h1><p>[5-15]</header><section><h2>[1-6]</h2><p>[30-140]<table><tr><td>[1-5]<td>[1-5]</table></section><form><p>(8-30)</form><div class="ad">(5-40)</div><footer>(5-20)</footer></article>
<article><h1>[3-9]</h1><p>[15-60]<ul><li>{+2-6}<li>{+2-6}</ul><p>[1-6]<p>[20-90]</article><section><h2>(1-4)</h2><p>(20-60)<p>(25-70)</section><div>(20-45)</div>
<article><h1>[3-9]</h1><p>[20-90]<p>[1-90]</article>
<div>{1}{2}</div><main><p>[1-120]<p>[1-60]</main>
<article><p>{+5-60}<p>[1-10]</article>
<article><div>[1-80]</div><ul><li>{+1-9}<li>[1-8]</ul></article>
<nav>{1}{1}</nav><article><p>[1-6]</article><nav>{1}</nav>
<h1>[3-10]</h1><p>[15-90]<p>[12-60]
<div>{1} {1}</div><p>[25-120]<p>[20-90]
<p>[25-200]
<div>[40-200]</div><div>(1-4)</div>
"""
_DRAWN = re.compile(r"\[(\d+)(?:-(\d+))?\]|\((\d+)(?:-(\d+))?\)|\{(\+?)(\d+)(?:-(\d+))?\}")
_MAIN, _OTHER = "main", "other"
VARIANTS = 25


def fill_layout(layout: str, draw: Callable[[int, int], int]) -> str:
    """A page source from a line of ``LAYOUTS``."""

    def text(m: re.Match) -> str:
        main, main_to, other, other_to, plus, link, link_to = m.groups()
        low = int(main or other or link)
        count = draw(low, int(main_to or other_to or link_to or low))
        words = " ".join([_MAIN if main or plus else _OTHER] * count)
        return f"<a href=x>{words}</a>" if link else words

    return _DRAWN.sub(text, layout)


def labelled_blocks(layouts: str = LAYOUTS, variants: int = VARIANTS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks in all variants of the labelled pages."""
    draws, rows, labels = np.random.default_rng(seed), [], []
    for layout in layouts.strip().split("\n"):
        for _ in range(variants):
            blocks = blocks_of(fill_layout(layout, lambda low, high: int(draws.integers(low, high + 1))))
            rows.append(features(blocks))
            labels += [b.text.startswith(_MAIN) for b in blocks]
    return np.concatenate(rows), np.array(labels)


@dataclass
class Node:
    """An inner node sends values up to ``limit`` to the left; a leaf has a label."""

    label: bool
    feature: int = -1
    limit: float = 0.0
    left: Node | None = None
    right: Node | None = None


def train_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 10) -> Node:
    """A decision tree by Gini impurity; of equal splits the first feature and limit win."""

    def impurity(positive: np.ndarray, count: np.ndarray) -> np.ndarray:
        share = positive / np.maximum(count, 1)
        return count * share * (1 - share)

    node = Node(bool(labels.mean() >= 0.5))
    n, positive = len(labels), labels.sum()
    best = (impurity(np.array(positive), np.array(n)) - 1e-9, -1, 0.0)
    if depth and 0 < positive < n:
        for feature in range(rows.shape[1]):
            order = np.argsort(rows[:, feature], kind="stable")
            values, up = rows[order, feature], np.cumsum(labels[order])
            count = np.arange(1, n + 1)
            cost = impurity(up, count) + impurity(positive - up, n - count)
            allowed = np.flatnonzero((values[:-1] < values[1:]) & (count[:-1] >= least) & (n - count[:-1] >= least))
            if len(allowed):
                k = allowed[cost[allowed].argmin()]
                if cost[k] < best[0] - 1e-12:
                    best = (cost[k], feature, (values[k] + values[k + 1]) / 2)
    if best[1] < 0:
        return node
    node.feature, node.limit = best[1], float(best[2])
    low = rows[:, node.feature] <= node.limit
    node.left = train_tree(rows[low], labels[low], depth - 1, least)
    node.right = train_tree(rows[~low], labels[~low], depth - 1, least)
    return node


def classify(node: Node, rows: np.ndarray) -> np.ndarray:
    """The label of each row."""
    if node.feature < 0:
        return np.full(len(rows), node.label)
    low = rows[:, node.feature] <= node.limit
    out = np.empty(len(rows), bool)
    out[low] = classify(node.left, rows[low])
    out[~low] = classify(node.right, rows[~low])
    return out


def main_text(page: str | None, tree: Node) -> str:
    """The kept blocks of a page, joined by an empty line."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return "\n\n".join(b.text for b, kept in zip(blocks, classify(tree, features(blocks)).tolist()) if kept)


def extract(pages: DataFrame, page: str = "html", keep: list[str] | None = None, tree: Node | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars`` (code points) to each page. Row by row, without a shuffle."""
    tree = tree or train_tree(*labelled_blocks())

    def make():
        def work(columns):
            texts = [main_text(value, tree) for value in columns[0]]
            return [texts, [len(t) for t in texts]]

        return work

    return add_columns(pages, [page], [StructField("text", StringType()), StructField("n_chars", LongType())], make, keep)
