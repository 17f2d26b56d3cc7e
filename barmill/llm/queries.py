"""The numbered operators as named queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.llm import (
    collocations, context_tree, fingerprint, language, licenses, mixing, pii, prefix_trie, shingle_join, site_lines, token_counts, transducer, wand,
)
from barmill.llm.util import documents

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op2_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.similar_documents(documents(spark, sf_dir), k=3, percent=90)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), TOKENIZER)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return licenses.by_document(docs, licenses.scan(docs, licenses.train(docs)))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    said = language.identify(docs.select("doc_id", "text"), language.taught(docs))
    return said.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op6_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", site_lines.host_of(F.col("url")).alias("host"), site_lines.page_lines(F.col("html")).alias("text")
    )
    clean = site_lines.drop_boilerplate(pages, F.col("host"), keep_whole=False)
    return clean.select("page_id", "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op7_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    asked = docs.where(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return wand.search(wand.build_index(docs), asked)


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.learn(docs))


def op9_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_edits(documents(spark, sf_dir))


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.round_trip(documents(spark, sf_dir), TOKENIZER)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(documents(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_entropy_mix, op2_shingle_join, op3_token_counts, op4_license_scan, op5_language_id, op6_site_lines,
        op7_block_max_search, op8_pii_spans, op9_multiset_fingerprints, op10_bpe_transducer,
        op11_prefix_trie, op12_context_tree, op13_collocations,
    )
}

_JOIN = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.least AS component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id) r USING (doc_id)"""


def _plain_text() -> str:
    text = "html"
    for hidden in site_lines.HIDDEN:
        text = f"regexp_replace({text}, '{hidden}', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{site_lines.BLOCKS}', chr(10), 'g'), '<[^>]*>', '', 'g')"
    return f"trim(regexp_replace({text}, '[ \\t]*\\n[ \\t\\n]*', chr(10), 'g'), ' ')"


_SITE = f"""
WITH pages_ AS (
  SELECT row_number() OVER () AS rid, page_id, nullif(lower(regexp_extract(url, '{site_lines.HOST}', 1)), '') AS host,
         string_split({_plain_text()}, chr(10)) AS lines
  FROM pages
),
each AS (SELECT rid, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM pages_),
counts AS (
  SELECT host, trim(line, ' ') AS k, count(DISTINCT rid) AS n FROM each
  WHERE trim(line, ' ') <> '' AND host IS NOT NULL GROUP BY ALL
),
boilerplate AS (
  SELECT c.host, c.k FROM counts c JOIN (SELECT host, count(*) AS total FROM pages_ GROUP BY host) t ON t.host = c.host
  WHERE n >= {site_lines.PAGES} AND n > total * {site_lines.RATIO}
),
left_ AS (
  SELECT rid, list(line ORDER BY place) AS lines FROM each e
  WHERE NOT EXISTS (SELECT 1 FROM boilerplate b WHERE b.host = e.host AND b.k = trim(e.line, ' ')) GROUP BY rid
),
chosen AS (
  SELECT p.page_id, p.host, len(p.lines) AS n, CASE WHEN p.lines IS NOT NULL THEN coalesce(l.lines, []) END AS kept
  FROM pages_ p LEFT JOIN left_ l USING (rid)
)
SELECT page_id, host, CAST(n AS BIGINT) AS n_lines, CAST(n - len(kept) AS BIGINT) AS n_dropped,
       sha256(array_to_string(kept, chr(10))) AS text_sha256
FROM chosen"""

#: The unsigned CRC-32 of a decimal number, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(s) + 1),
    lambda i: list_prepend(ascii(s[i])::BIGINT, [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295)"""

_TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT c, c - c % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT c, c::VARCHAR AS s FROM turns)),
lent AS (SELECT v.c, v.h, count(t.p) AS k FROM convs v LEFT JOIN turns t ON t.c = v.base AND t.p <= v.h GROUP BY ALL),
built AS (
  SELECT v.c, t.p, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base AND t.p <= v.h
  UNION ALL SELECT t.c, t.p - l.h + l.k, t.role, t.text FROM turns t JOIN lent l ON l.c = t.c WHERE t.p > l.h
),
paths AS (
  SELECT c, p AS d, sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '' ORDER BY p) OVER
    (PARTITION BY c ORDER BY p ROWS UNBOUNDED PRECEDING)) AS k, strlen(text) AS bytes FROM built
  UNION ALL SELECT c, 0, '', 0 FROM convs
),
up AS (SELECT c, d, k, bytes, lag(k) OVER (PARTITION BY c ORDER BY d) AS pk, max(d) OVER (PARTITION BY c) = d AS ends FROM paths),
nodes AS (
  SELECT k, d, min(c) AS m, count(*) AS n, any_value(pk) AS pk, (count(*) - 1) * any_value(bytes) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends
  FROM up GROUP BY k, d
),
kids AS (SELECT pk AS k, count(*) AS n FROM nodes WHERE pk IS NOT NULL GROUP BY pk),
below AS (
  SELECT p.k, sum((q.n IS NULL)::INT) AS leaves, sum(v.saved) AS saved
  FROM nodes v JOIN paths p ON p.c = v.m AND p.d <= v.d LEFT JOIN kids q ON q.k = v.k GROUP BY p.k
)
SELECT v.m AS conv_id, v.d AS depth, u.m AS parent_conv_id, v.n AS n_convs, coalesce(q.n, 0) AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
FROM nodes v JOIN below b USING (k) LEFT JOIN kids q USING (k) LEFT JOIN nodes u ON u.k = v.pk"""

_MINED = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
phrases AS (
  SELECT lang, p, count(*) AS f FROM (
    SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda k: list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])))) AS p
    FROM words
  ) GROUP BY ALL HAVING f >= 100
),
longer AS (
  SELECT lang, p[:-2] AS p, f FROM phrases WHERE len(p) > 1 UNION ALL SELECT lang, p[2:], f FROM phrases WHERE len(p) > 1
),
kept AS (
  SELECT * FROM phrases c WHERE len(p) > 1 AND NOT EXISTS (SELECT 1 FROM longer e WHERE e.lang = c.lang AND e.p = c.p AND e.f >= c.f)
),
cuts AS (SELECT lang, p, f, unnest(range(1, len(p))) AS k FROM kept),
scores AS (
  SELECT c.lang, c.p, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
         1000::HUGEINT * c.f * t.n // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.p = c.p[:c.k] JOIN phrases y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]
  JOIN total t ON t.lang = c.lang
),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT *, array_to_string(p, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
  FROM lowest
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""

ORACLES: dict[str, str] = {
    "op2_shingle_join": _JOIN, "op6_site_lines": _SITE, "op11_prefix_trie": _TRIE,
    "op13_collocations": _MINED,
}
