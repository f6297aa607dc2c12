from __future__ import annotations

from checks.corpus import documents, pages, with_corpus
from corpuswright.functions import text as tx
from corpuswright.operators import profile as p
from pyspark.sql import functions as F

WORDS_SQL = r"len(regexp_extract_all({c}, '[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_''-]*'))"
TOKENS_SQL = r"len(regexp_extract_all({c}, '\S+'))"
BODY_SQL = (
    "CASE WHEN starts_with(markdown, '---' || chr(10)) AND position(chr(10) || '---' || chr(10) IN markdown[5:]) > 0 "
    "THEN ltrim(markdown[position(chr(10) || '---' || chr(10) IN markdown[5:]) + 9:], chr(10)) ELSE markdown END"
)
HEADINGS_SQL = (
    r"list_transform(list_filter(string_split(markdown, chr(10)), lambda l: regexp_matches(l, '^#{1,6}\s+(.+?)\s*$')), "
    r"lambda l: trim(regexp_extract(l, '^#{1,6}\s+(.+?)\s*$', 1)))"
)


def simhash_sql(source: str, key: str, text: str, name: str) -> str:
    """Two CTEs ending in ``name`` (key, simhash)."""
    return f"""
{name}_tok AS (SELECT {key} AS k, t, count(*) AS c FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}),
      '[a-z0-9]{{3,}}')) AS t FROM {source}) GROUP BY ALL),
{name}_bits AS (SELECT k, b, sum(CASE WHEN (h >> b::INT) & 1::UBIGINT = 1 THEN c ELSE -c END) AS w
      FROM (SELECT k, c, ('0x' || substr(sha256(t), 1, 16))::UBIGINT AS h FROM {name}_tok), range(64) r(b) GROUP BY ALL),
{name}_val AS (SELECT k, sum(CASE WHEN w >= 0 THEN 1::HUGEINT << b::INT ELSE 0 END)::UBIGINT AS v
      FROM {name}_bits GROUP BY k),
{name} AS (SELECT {key} AS document_id, coalesce(printf('%016x', v), '0000000000000000') AS simhash, coalesce(v, 0) AS v
      FROM {source} LEFT JOIN {name}_val ON k = {key})"""


def _text_stats(spark, sf):
    return p.text_stats(pages(spark, sf)).select(
        "document_id", "score_words", "word_count", "heading_count", "link_count"
    )


QUERIES = {
    "document_key": lambda s, d: documents(s, d).select("n", "document_id", "source_content_hash"),
    "text_stats": _text_stats,
    "extract_headings": lambda s, d: documents(s, d).select(
        "document_id", F.posexplode(tx.extract_headings(F.col("markdown"))).alias("pos", "heading")
    ),
    "strip_front_matter": lambda s, d: documents(s, d).select(
        "document_id", F.sha2(tx.strip_front_matter(F.col("markdown")), 256).alias("body_sha")
    ),
    "content_availability": lambda s, d: p.content_availability(documents(s, d)).select(
        "document_id", "content_availability"
    ),
    "simhash64": lambda s, d: p.simhash64(documents(s, d), "text"),
}

SQL = {
    "document_key": with_corpus("SELECT n, document_id, source_content_hash FROM corpus"),
    "text_stats": with_corpus(
        f"SELECT document_id, {WORDS_SQL.format(c='text')} AS score_words, "
        f"{TOKENS_SQL.format(c='text')} AS word_count, len({HEADINGS_SQL}) AS heading_count, link_count FROM corpus"
    ),
    "extract_headings": with_corpus(
        "SELECT document_id, i - 1 AS pos, h[i] AS heading FROM "
        f"(SELECT document_id, {HEADINGS_SQL} AS h FROM corpus), unnest(range(1, len(h) + 1)) u(i)"
    ),
    "strip_front_matter": with_corpus(f"SELECT document_id, sha256({BODY_SQL}) AS body_sha FROM corpus"),
    "content_availability": with_corpus(
        f"SELECT document_id, CASE WHEN contains(lower({BODY_SQL}), 'no exportable body content') THEN 'empty' "
        f"WHEN {WORDS_SQL.format(c='text')} < 80 THEN 'thin' ELSE 'normal' END AS content_availability FROM corpus"
    ),
    "simhash64": with_corpus(
        "SELECT document_id, simhash FROM sig", simhash_sql("corpus", "document_id", "text", "sig")
    ),
}
