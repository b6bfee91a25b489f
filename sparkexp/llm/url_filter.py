"""Allow and block rules for URLs, by hashed host-suffix and path-prefix expressions.

A rule is a host and a path. It fits a URL whose host is the rule's or a subdomain
of it and whose path starts with the rule's. Each URL is expanded into expressions:
a suffix of its host (cut at dots) followed by a prefix of its path (cut behind a
slash). A rule has one such expression: its host and its path up to the last slash.
URLs and rules meet where the first 32 bits of the expressions' SHA-256 are equal;
then the full digest must be equal and the URL's path must start with the whole of
the rule's. Of the rules that fit the longest wins (host and path together), then
the one with the longer host, then block before allow.

Only built-in functions are used. Hosts are cut no deeper than the rule with most
labels and paths no deeper than the one with most slashes, so a URL of any length has
a bounded number of expressions; none that could match is left out. Distinct URLs are
found first, with partial aggregation, so repeated ones cost nothing further. Up to
``BROADCAST_RULES`` rules of ``BROADCAST_BYTES`` together are broadcast. More are joined by a shuffle, in which
expressions that hold over a thousandth of all (a thousand at most, so that their
list may be broadcast) are salted.

Defined results: a null URL, or one without ``://``, has an empty host and path. A URL
that no rule fits gets ``default``. A null host or path of a rule is empty; rules that
are alike count once; an action other than allow or block raises. Every input row comes back
once, repeated rows too. Columns ``host``, ``path``, ``rule`` and ``verdict`` of the input, in
any case, are replaced. Tables without rows are fine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkexp.llm.rows import position_of

# Beyond either of these the rules are not broadcast.
BROADCAST_RULES = 20_000
BROADCAST_BYTES = 8_000_000
# An expression is hot if it is more than one in HOT_PARTS; so there are fewer hot ones than this.
HOT_PARTS = 1_000
SALTS = 64
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> list[Column]:
    """The URL's host (after the first ``://``, A-Z in lower case) and its path."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return [F.translate(host, _UPPER, _LOWER), path]


def _first(text: Column, mark: str, count: Column) -> Column:
    """What stands before the ``count``-th mark; behind it from the end when negative."""
    return F.call_function("substring_index", text, F.lit(mark), count.cast("int"))


def _count(text: Column, letter: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), folder), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _prepared(rules: DataFrame) -> DataFrame:
    """The rules with their expression's digest."""
    action, host, path = (F.col(f"_{position_of(rules, name)}") for name in ("action", "host", "path"))
    known = F.when(action.isin("allow", "block"), action).otherwise(
        F.raise_error(F.concat(F.lit("A rule's action is neither allow nor block: "), F.coalesce(action, F.lit("null"))))
    )
    parts = rules.toDF(*[f"_{i}" for i in range(len(rules.columns))]).select(
        known.alias("action"),
        F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER).alias("rule_host"),
        F.coalesce(path, F.lit("")).alias("rule_path"),
    )
    depth = _count(F.col("rule_path"), "/")
    folder = _first(F.col("rule_path"), "/", depth)
    folder = F.when(depth > 0, F.concat(folder, F.lit("/"))).otherwise(F.lit(""))
    digest = _digest(F.col("rule_host"), folder)
    return parts.distinct().select(
        "*", (_count(F.col("rule_host"), ".") + 1).alias("labels"), depth.alias("depth"), digest.alias("digest"), _short(digest).alias("short")
    )


def _expressions(urls: DataFrame, labels: int, depth: int) -> DataFrame:
    """A row for each expression of each URL, by the number of labels and slashes it takes."""
    suffixes = F.sequence(F.lit(1), F.least(_count(F.col("host"), ".") + 1, F.lit(labels)))
    prefixes = F.sequence(F.lit(0), F.least(_count(F.col("path"), "/"), F.lit(depth)))
    cut = urls.select("host", "path", F.explode(suffixes).alias("taken_labels"), prefixes.alias("prefixes"))
    cut = cut.select("host", "path", "taken_labels", F.explode("prefixes").alias("taken_slashes"))
    return cut.withColumn("short", _short(_expression_digest()))


def _expression_digest() -> Column:
    suffix = _first(F.col("host"), ".", -F.col("taken_labels"))
    folder = _first(F.col("path"), "/", F.col("taken_slashes"))
    folder = F.when(F.col("taken_slashes") > 0, F.concat(folder, F.lit("/"))).otherwise(F.lit(""))
    return _digest(suffix, folder)


def _salted(expressions: DataFrame, rules: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: hot expressions are spread, their rules copied."""
    counted = expressions.groupBy("short").count()
    total = expressions.agg(F.count(F.lit(1)).alias("n")).first().n
    hot = F.broadcast(counted.where(F.col("count") * HOT_PARTS > total).select("short", F.lit(True).alias("hot")))
    spread = F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int")
    left = expressions.join(hot, "short", "left").withColumn("salt", F.when(F.col("hot"), spread).otherwise(F.lit(0))).drop("hot")
    copies = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = rules.join(hot, "short", "left").withColumn("salt", F.explode(copies)).drop("hot")
    return left, right


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    keep: Sequence[str] | None = None,
    default: str = DEFAULT,
    broadcast_rules: int = BROADCAST_RULES,
    salts: int = SALTS,
) -> DataFrame:
    """Add ``host``, ``path``, the ``rule`` that decides (or null) and the ``verdict`` to each page.

    ``rules`` has text columns ``action``, ``host`` and ``path``. ``keep`` names the columns of
    ``pages`` that stay (default: all).
    """
    added = ("host", "path", "rule", "verdict")
    kept = [
        (i, name)
        for i, name in enumerate(pages.columns)
        if (keep is None or name in keep) and name.lower() not in added
    ]
    url_at = position_of(pages, url)
    rows = pages.toDF(*[f"_{i}" for i in range(len(pages.columns))])
    host, path = host_and_path(F.col(f"_{url_at}").cast("string"))
    rows = rows.select(*[f"_{i}" for i, _ in kept], host.alias("host"), path.alias("path"))

    prepared = _prepared(rules)
    size = prepared.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("rule_host") + F.octet_length("rule_path")).alias("bytes"),
        F.max("labels").alias("labels"),
        F.max("depth").alias("depth"),
    ).first()
    named = [F.col(f"_{i}").alias(name) for i, name in kept]
    if not size.n:
        nothing = [F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")]
        return rows.select(*named, "host", "path", *nothing)

    left, right = _expressions(rows.select("host", "path").distinct(), size.labels, size.depth), prepared
    on = ["short"]
    if size.n <= broadcast_rules and size.bytes <= BROADCAST_BYTES:
        right = F.broadcast(right)
    else:
        left, right = _salted(left, right, salts)
        on.append("salt")
    met = left.join(right, on)
    suffix = _first(F.col("host"), ".", -F.col("taken_labels"))
    confirmed = (_expression_digest() == F.col("digest")) & (suffix == F.col("rule_host"))
    fits = confirmed & F.startswith(F.col("path"), F.col("rule_path"))
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        "action",  # block comes after allow
        "rule_host",
        "rule_path",
    )
    best = met.where(fits).groupBy("host", "path").agg(F.max(rank).alias("best"))
    judged = rows.join(best, ["host", "path"], "left")
    return judged.select(
        *named,
        "host",
        "path",
        F.concat(F.col("best.rule_host"), F.col("best.rule_path")).alias("rule"),
        F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"),
    )
