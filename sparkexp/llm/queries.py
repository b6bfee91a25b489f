"""The registered queries of this subpackage. Every one reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkexp.llm import (
    decontaminate,
    fill_middle,
    html_text,
    language_id,
    ngram_join,
    packing,
    quality,
    ranked_search,
    secret_scan,
    sharding,
    token_records,
    url_filter,
    warc_audit,
)
from sparkexp.llm.ship import shipped
from sparkexp.sources.scratch import scratch_path

VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in two replicas, one with a flipped byte in about every hundredth record."""
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    root = scratch_path(spark, "warc")
    index = warc_audit.write_warc(pages, f"{root}/one")
    damaged = F.pmod(F.crc32(F.col("page_id").cast("string").cast("binary")), F.lit(100)) == 7
    warc_audit.copy_replica(index, f"{root}/one", f"{root}/other", damaged)
    return warc_audit.audit(index, f"{root}/one", f"{root}/other")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return sharding.digest(sharding.shuffle_into_shards(docs))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages", "page_id", "url", "html"), keep=["page_id", "url"])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    trusted = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
    ratio = quality.log_ratio(*quality.count_grams(docs, trusted, "doc_id", "text"))
    return quality.judge(docs, ratio, keep=["doc_id"]).drop("llr")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.digest(packing.pack(docs, public_tokenizers.path(VOCABULARY), added_tokens=True))


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    folder = scratch_path(spark, "records")
    index = token_records.write_records(docs, folder, public_tokenizers.path(VOCABULARY), added_tokens=True)
    files = token_records.number_of_files(spark, index)
    return token_records.digest(token_records.read_records(index, folder, files, with_ids=False), index)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    items = _table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.digest(decontaminate.find_spans(docs, items, keep=["doc_id"]))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    profiles = language_id.train_profiles(docs.where(~language_id.held_out()))
    found = language_id.identify(docs.select("doc_id", "text"), profiles, keep=["doc_id"])
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return secret_scan.digest(docs)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return fill_middle.digest(fill_middle.fill_in_middle(docs, keep=["doc_id"]))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return ranked_search.search(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"))


# The rules of the URL filter.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{action}', '{host}', '{path}')" for action, host, path in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(action, host, path)")
    return url_filter.filter_urls(_table(spark, sf_dir, "pages", "page_id", "url"), rules, keep=["page_id"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    return {name: shipped(function) for name, function in globals().items() if name.startswith("op")}


_WORDS = r"[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+"
_SOLID = r"[^\x{20}\x{09}-\x{0D}]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {
        "op1_ngram_join": f"""
            WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
                                        regexp_extract_all(lower(coalesce(text, '')), '{_WORDS}') AS w FROM documents),
            s AS (SELECT DISTINCT r, g FROM (SELECT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS g FROM d)),
            n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
            p AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
            l AS (SELECT x, y FROM p JOIN n n1 ON n1.r = x JOIN n n2 ON n2.r = y WHERE 10 * c >= 8 * (n1.n + n2.n - c)),
            reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x),
            c AS (SELECT x AS r, min(doc_id) AS class_id FROM reach JOIN d ON d.r = y GROUP BY x),
            k AS (SELECT x AS r, count(*) AS n_links FROM l GROUP BY x)
            SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM d JOIN c USING (r) LEFT JOIN k USING (r)""",
        "op5_quality_rules": f"""
            WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                              regexp_extract_all(coalesce(text, ''), '{_SOLID}') AS w FROM documents),
            h AS (SELECT r, list_transform(w, lambda x: CAST('0x' || substr(md5(x), 1, 15) AS BIGINT)) AS h FROM d),
            b AS (SELECT r, unnest(list_concat(list_transform(h, lambda x: x % 16384),
                      list_transform(range(1, len(h)), lambda i: (h[i] % 65521 * 31 + h[i + 1] % 65521) % 16384))) AS g FROM h),
            good AS (SELECT DISTINCT r FROM d WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)),
            counts AS (SELECT g, count(*) AS n, count(good.r) AS m FROM b LEFT JOIN good USING (r) GROUP BY g),
            buckets AS (SELECT range AS g, coalesce(n, 0) + 1.0::DOUBLE AS n, coalesce(m, 0)::DOUBLE AS m
                        FROM range(16384) LEFT JOIN counts ON g = range),
            shares AS (SELECT g, n / sum(n) OVER () AS q, m, sum(m) OVER () AS total FROM buckets),
            ratio AS (SELECT g, ln((m + 65536 * q) / (total + 65536)) - ln(q) AS x FROM shares),
            score AS (SELECT r, avg(x) AS llr FROM b JOIN ratio USING (g) GROUP BY r),
            lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
                      WHERE regexp_matches(line, '{_SOLID}') GROUP BY r),
            g3 AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM (
                      SELECT r, i, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
            again AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS k FROM g3 WHERE n > 1) GROUP BY r),
            base AS (SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                            CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
                            CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words
                     FROM d LEFT JOIN lines USING (r) LEFT JOIN again USING (r)),
            failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
            SELECT failed.* EXCLUDE (r), NOT base_failed AND coalesce(llr, 0) >= {quality.THRESHOLD} AS kept
            FROM failed LEFT JOIN score USING (r)""",
        "op11_fill_middle": """
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                              sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
            h AS (SELECT *, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS x FROM d),
            c AS (SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
                         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR x[3] % 100 >= 90 THEN 'plain'
                              WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
            p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1, n - b) AS suffix FROM c)
            SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
                   CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
                   sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                               ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
                   sha256(t) AS restored_sha256 FROM p""",
        "op12_ranked_search": f"""
            WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_WORDS}') AS w FROM documents),
            n AS (SELECT r, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
            totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
            tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
            weights AS (SELECT t, CAST(floor(CAST(1000 AS DOUBLE) * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS x
                        FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), totals),
            q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all(coalesce({_LOWER}, ''), '{_WORDS}')) AS t
                  FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, t),
            scores AS (SELECT item_id, r, CAST(sum(c * x * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
                       FROM q JOIN weights USING (t) JOIN tf USING (t) JOIN n USING (r), totals GROUP BY item_id, r)
            SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score
            FROM scores JOIN d USING (r) WHERE score > 0 WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
            QUALIFY row_number() OVER best <= 10""",
        "op13_url_filter": f"""
            WITH r(action, h, p) AS (VALUES {", ".join(str(rule) for rule in RULES)}),
            u AS (SELECT row_number() OVER () AS i, page_id, CASE WHEN contains(url, '://')
                      THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
            parts AS (SELECT i, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
            best AS (SELECT i, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
                     FROM parts, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY i)
            SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN best USING (i)""",
        "op8_decontaminate": f"""
            WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce({_LOWER}, ''), '{_WORDS}') AS w
                       FROM documents),
            b AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS name,
                         regexp_extract_all(coalesce({_LOWER}, ''), '{_WORDS}') AS w FROM benchmark),
            windows AS (SELECT DISTINCT name, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
                        FROM (SELECT name, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
            sizes AS (SELECT DISTINCT n FROM windows),
            places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
            found AS (SELECT r, i, p.n, name FROM (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
                             FROM places, sizes WHERE i + n - 1 <= len(w)) p JOIN windows USING (n, g)),
            hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM found) GROUP BY r),
            names AS (SELECT r, count(DISTINCT name) AS n_items, string_agg(DISTINCT name, ',' ORDER BY name) AS s
                      FROM found GROUP BY r)
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
                   CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
                   coalesce(n_hit, 0) > 0 AS contaminated
            FROM d LEFT JOIN hit USING (r) LEFT JOIN names USING (r)""",
    }
