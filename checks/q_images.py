"""Images."""

from __future__ import annotations

import pandas as pd
from checks.corpus import attachments, documents, table, with_corpus
from checks.q_classify import any_sql, q
from checks.q_profile import TOKENS_SQL
from checks.q_reports import ART, artifacts
from corpuswright import fixed_values as fv
from corpuswright.operators import images as im
from corpuswright.operators import reports as rp
from pyspark.sql import functions as F


def found(spark, sf):
    return im.discover_images(documents(spark, sf), attachments(spark, sf))


def scored(spark, sf):
    return im.image_group_keys(im.score_images(found(spark, sf), im.page_facts(documents(spark, sf))))


def decided(spark, sf):
    return im.image_select(im.image_rank(im.image_page_caps(scored(spark, sf), cap=4, report_cap=2)))


def _refs(spark, sf):
    """URLs naming attachments of another page, in exact and in changed case, or unknown ones."""
    return table(spark, sf, "part").selectExpr(
        "concat('doc:', p_partkey) document_id", "cast((p_partkey + p_size % 2) % 200 as string) page_id", "'s' space_key",
        "0 line", "0 in_line",
        "concat('https://wiki.example.com/', case when p_size % 3 = 0 then concat('download/attachments/', p_partkey % 200, '/') else 'files/' end, "
        "case when p_size % 5 = 0 then upper(concat('p-', p_partkey % 200)) else concat(replace(p_name, ' ', case when p_size % 7 = 0 then '+' else '-' end), '-', p_partkey) end, "
        "element_at(array('.png', '.pdf', '.PNG', '.xlsx'), p_size % 4 + 1), '?version=', p_size) raw",
        "cast(null as string) nearby_heading", "'' context",
    )


CONTENT = {
    "spark": "case p_size % 4 when 0 then unhex(concat('89504E470D0A1A0A0000000D49484452', lpad(hex(p_size * 4), 8, '0'), lpad(hex(p_size * 3), 8, '0'), '0802000000')) "
    "when 1 then unhex(concat('474946383961', lpad(hex((p_size * 4) % 256), 2, '0'), lpad(hex((p_size * 4) div 256), 2, '0'), lpad(hex((p_size * 3) % 256), 2, '0'), lpad(hex((p_size * 3) div 256), 2, '0'))) "
    "when 2 then unhex(concat('FFD8FFE000104A46494600010100000100010000FFC0001108', lpad(hex(p_size * 3), 4, '0'), lpad(hex(p_size * 4), 4, '0'), '03012200021101031101')) "
    "else encode(concat('plain ', p_size), 'UTF-8') end",
}
CONTENT["duckdb"] = (
    CONTENT["spark"].replace(" div ", " // ").replace("hex(p_size * 4)", "to_hex(p_size * 4)").replace("hex(p_size * 3)", "to_hex(p_size * 3)")
    .replace("hex((p_size", "to_hex((p_size").replace("encode(concat('plain ', p_size), 'UTF-8')", "encode(concat('plain ', p_size))")
)


def image_rows(spark, sf):
    t = table(spark, sf, "part").selectExpr(
        "concat('doc:', p_partkey % 300) document_id", "cast(p_partkey % 300 as string) page_id", "p_brand space_key",
        "cast(p_partkey as int) rank", "concat('image-', p_partkey) image_id", "p_size", "p_partkey", f"{CONTENT['spark']} content",
        "'image/png' mime_type",
    )
    rows = t.selectExpr(
        "*", "case when p_size % 6 = 5 then 'url' when p_size % 6 = 4 then 'data_url' else 'file' end source_kind",
        "case when p_size % 6 = 5 then concat('https://x.example.com/', p_partkey, '.png') "
        "when p_size % 6 = 4 then concat('data:image/gif;base64,', base64(content)) "
        "else concat(page_id, '/attachments/', case when p_size % 11 = 0 then 'site-logo.' else 'pic' end, p_partkey, '.png') end source",
    )
    decoded = F.when(F.col("source_kind") == "data_url", im.data_url_content(F.col("source"))).when(
        F.col("source_kind") == "url", F.lit(None)
    )
    return rows.withColumn("content", F.when(F.expr("p_size % 13 = 1"), F.lit(None)).when(F.col("source_kind") == "file", F.col("content")).otherwise(decoded))


def profiled(spark, sf):
    return im.image_profile(image_rows(spark, sf), min_pixels=600)


def earlier(spark, sf):
    """Extractions of an earlier run for some contents."""
    rows = profiled(spark, sf).where("p_size % 8 in (1, 2) and content is not null")
    return rows.select(
        "space_key", "page_id", F.col("rank").alias("pos"), "content_sha256", F.lit("success").alias("status"),
        F.concat(F.lit("old "), "content_sha256").alias("ocr_text"), F.lit("c").alias("caption"), F.lit(0.5).alias("confidence"),
        F.lit("p0").alias("provider"), F.lit("m0").alias("model"), F.lit("v0").alias("prompt_version"),
    )


def read_image(batch: pd.DataFrame) -> pd.DataFrame:
    """Stand-in model: the text names the content, some contents give nothing."""
    sha = batch["content_sha256"]
    empty = sha.str[0].isin(list("0123"))
    return pd.DataFrame(
        {
            "content_sha256": sha, "ocr_text": ("read " + sha).where(~empty, ""), "caption": "", "confidence": 0.9,
            "error_type": pd.Series([None] * len(batch), index=batch.index, dtype="object"),
        }
    )


def extracted(spark, sf):
    cache = im.extraction_cache(earlier(spark, sf))
    return im.extract_images(profiled(spark, sf), cache, read_image, provider="p1", model="m1")


def _pages(spark, sf):
    return image_rows(spark, sf).select("document_id", "page_id", F.lit("s").alias("space_key"), F.sha2("document_id", 256).alias("source_content_hash")).distinct()


def _to_do(spark, sf):
    done = im.image_artifacts(extracted(spark, sf), _pages(spark, sf)).withColumn(
        "source_content_hash", F.when(F.expr("cast(page_id as int) % 5 = 0"), "other").otherwise(F.col("source_content_hash"))
    )
    return im.images_to_do(_pages(spark, sf), done).select("document_id")


def rendered(spark, sf):
    rows = rp.visual_images(artifacts(spark, sf)).select(
        F.concat_ws(":", "space_key", F.expr("cast(page_id as int) % 40")).alias("document_id"),
        F.expr("cast(page_id as int) * 10 + pos").alias("rank"), F.concat("page_id", F.lit("/"), "image_id").alias("image_id"), "source", "status",
        F.lit("").alias("caption"), "content_sha256", F.expr("repeat(concat(page_id, ' '), 30)").alias("ocr_text"),
    )
    return im.image_dedupe_render(rows, max_images=6, max_ocr_chars=100)


QUERIES = {
    "previous_heading": lambda s, d: im.image_references(documents(s, d)).select("document_id", "line", "in_line", "nearby_heading"),
    "nearby_lines": lambda s, d: im.image_references(documents(s, d)).select("document_id", "line", "in_line", F.sha2("context", 256).alias("context_sha")),
    "resolve_image_refs": lambda s, d: im.resolve_image_refs(_refs(s, d), attachments(s, d)).select("document_id", "source", "source_kind", "mime_type"),
    "discover_images": lambda s, d: found(s, d).select("document_id", "source_order", "source", "source_kind", "mime_type", "nearby_heading"),
    "score_images": lambda s, d: scored(s, d).select("document_id", "source", "selection_score", "selection_reasons"),
    "image_group_keys": lambda s, d: scored(s, d).select("document_id", "source", "group_key"),
    "image_page_caps": lambda s, d: im.image_page_caps(
        scored(s, d), cap=20, priority_pages=["1", "5", "9"], priority_cap=40
    ).groupBy("document_id").agg(F.max("page_cap").alias("page_cap")),
    "image_rank": lambda s, d: im.image_rank(scored(s, d)).select("document_id", "source", "rank"),
    "image_select": lambda s, d: decided(s, d).select("document_id", "source", "decision"),
    "image_ids": lambda s, d: im.image_ids(decided(s, d).where("decision = 'selected'")).select("document_id", "source", "image_id"),
    "omitted_image_inventory": lambda s, d: im.omitted_image_inventory(decided(s, d)).select("document_id", "source", "omitted_reason", "selection_score"),
    "image_profile": lambda s, d: profiled(s, d).select("image_id", "content_sha256", "width", "height", "low_value_reason"),
    "image_cache_join": lambda s, d: im.image_cache_join(profiled(s, d), im.extraction_cache(earlier(s, d))).select(
        "image_id", "cache_hit", F.col("answer.ocr_text").alias("ocr_text")
    ),
    "extract_images": lambda s, d: extracted(s, d).select("image_id", "status", "ocr_text", "error_type", "cache_hit"),
    "image_artifacts": lambda s, d: im.image_artifacts(extracted(s, d), _pages(s, d)).select(
        "document_id", "status", "image_count", "images_succeeded", "images_failed", "images_skipped", F.size("images").alias("listed")
    ),
    "images_to_do": _to_do,
    "visual_index_rows": lambda s, d: im.visual_index_rows(im.image_artifacts(extracted(s, d), _pages(s, d))).select("document_id", "image_id", "status"),
    "image_dedupe_render": lambda s, d: rendered(s, d).select("document_id", "image_id", "outcome", F.length("ocr_shown").alias("chars"), "ocr_cut"),
}

IMG = r"""!\[[^\]]*\]\(([^)\s]+)(?:\s+"[^"]*")?\)"""
REFS = f"""
il AS (SELECT document_id, page_id, string_split(markdown, chr(10)) AS ls FROM base WHERE contains(markdown, '](')),
ih AS (SELECT document_id, page_id, ls, i - 1 AS line, regexp_extract_all(ls[i], {q(IMG)}, 1) AS raws FROM il, unnest(range(1, len(ls) + 1)) u(i)
  WHERE regexp_matches(ls[i], {q(IMG)})),
ir AS (SELECT document_id, page_id, line, k - 1 AS in_line, raws[k] AS raw,
  nullif(trim(regexp_replace((list_filter(list_transform(ls[1:line], lambda l: trim(l)), lambda l: starts_with(l, '#')))[-1], '^#+', '')), '') AS nearby_heading,
  array_to_string(ls[greatest(line, 1):line + 2], chr(10)) AS context FROM ih, unnest(range(1, len(raws) + 1)) u(k))"""
_MIME = "CASE lower(regexp_extract({c}, '\\.([A-Za-z]+)$', 1)) WHEN 'jpg' THEN 'image/jpeg' WHEN 'jpeg' THEN 'image/jpeg' WHEN 'png' THEN 'image/png' WHEN 'gif' THEN 'image/gif' WHEN 'webp' THEN 'image/webp' END"
FOUND = f"""
fr AS (SELECT document_id, page_id, 0 AS g, line, in_line, CASE WHEN starts_with(raw, 'http') THEN raw ELSE concat(page_id, '/', raw) END AS source,
  CASE WHEN starts_with(raw, 'http') THEN 'url' ELSE 'file' END AS source_kind, nearby_heading, context FROM ir
  UNION ALL SELECT document_id, base.page_id, 1, 0, 0, concat(base.page_id, '/attachments/', name), 'file', NULL, name FROM attachments_t JOIN base USING (page_id)
  WHERE regexp_matches(name, '(?i)\\.(gif|jpeg|jpg|png|webp)$')),
fd AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY g, line, in_line, source) AS source_order FROM
  (SELECT * FROM fr QUALIFY row_number() OVER (PARTITION BY document_id, source ORDER BY g, line, in_line) = 1)),
fi AS (SELECT *, {_MIME.format(c="split_part(source, '?', 1)")} AS mime_type FROM fd)"""
_SAY = "lower(concat_ws(' ', nullif(source, ''), nullif(nearby_heading, ''), nullif(context, '')))"
_RULES = [("context <> ''", 20, "markdown_reference")]
_RULES += [(f"regexp_matches(said, {q(p)})", 25, n) for n, p in fv.IMAGE_TOPICS.items()]
_RULES += [("few", 15, "low_text_page"), (f"regexp_matches(said, {q(fv.IMAGE_LOW_VALUE)})", -35, "likely_low_value_visual"), ("source_kind = 'url'", -20, "remote_not_local")]
_SCORE = " + ".join(["10", *[f"(CASE WHEN {c} THEN {p} ELSE 0 END)" for c, p, _ in _RULES]])
_REASON = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {q(n)} END" for c, _, n in _RULES) + "], lambda x: x IS NOT NULL)"
SCOREI = f"""
pf AS (SELECT document_id, {TOKENS_SQL.format(c='text')} BETWEEN 1 AND 149 AS few,
  regexp_matches(lower(concat(title, ' ', array_to_string(labels, ' '), ' ', array_to_string(ancestor_titles, ' '))), {q(fv.REPORT_WORDS)}) AS rep FROM base),
i0 AS (SELECT fi.*, few, rep, {_SAY} AS said FROM fi JOIN pf USING (document_id)),
i1 AS (SELECT *, {_SCORE} AS score, {_REASON} AS reasons,
  regexp_replace(regexp_replace(regexp_replace(said, '\\b\\d{{1,4}}[-_:./]?\\d{{0,4}}[-_:./]?\\d{{0,4}}\\b', '#', 'g'), 'image[-_. ]*#', 'image', 'g'), '[^a-z#]+', ' ', 'g') AS masked FROM i0),
i2 AS (SELECT *, CASE WHEN rep OR regexp_matches(said, {q(fv.DASHBOARD_WORDS)}) THEN nullif(array_to_string((list_filter(string_split(masked, ' '),
  lambda w: w NOT IN ('', 'attachments', 'pages')))[1:12], ' '), '') END AS group_key FROM i1),
i3 AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY score DESC, source_order) AS rank, CASE WHEN rep THEN 2 ELSE 4 END AS cap FROM i2),
i4 AS (SELECT *, group_key IS NULL OR row_number() OVER (PARTITION BY document_id, group_key ORDER BY rank) <= 3 AS okk FROM i3),
i5 AS (SELECT *, coalesce(sum(okk::INT) OVER (PARTITION BY document_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef FROM i4),
dec AS (SELECT *, CASE WHEN bef >= cap THEN 'page_cap_omitted' WHEN NOT okk THEN 'representative_group_omitted' ELSE 'selected' END AS decision FROM i5)"""
PROF = f"""
pc AS (SELECT *, (p_partkey % 300)::VARCHAR AS page_id, concat('doc:', p_partkey % 300) AS document_id, concat('image-', p_partkey) AS image_id, {CONTENT['duckdb']} AS raw,
  CASE WHEN p_size % 6 = 5 THEN 'url' WHEN p_size % 6 = 4 THEN 'data_url' ELSE 'file' END AS kind FROM part),
pb AS (SELECT *, CASE WHEN p_size % 13 = 1 OR kind = 'url' THEN NULL ELSE sha256(raw) END AS h FROM pc),
pd AS (SELECT *, CASE WHEN h IS NOT NULL AND p_size % 4 <> 3 THEN p_size * 4 END AS w, CASE WHEN h IS NOT NULL AND p_size % 4 <> 3 THEN p_size * 3 END AS ht FROM pb),
pp AS (SELECT *, CASE WHEN kind = 'file' AND p_size % 11 = 0 THEN 'filename suggests logo/icon/placeholder content' WHEN w * ht <= 600 THEN
  concat('tiny image dimensions ', w, 'x', ht) END AS low FROM pd),
old AS (SELECT DISTINCT h FROM pp WHERE p_size % 8 IN (1, 2) AND h IS NOT NULL),
xi AS (SELECT pp.*, old.h IS NOT NULL AS hit, row_number() OVER (PARTITION BY pp.h, (old.h IS NULL AND kind <> 'url' AND low IS NULL AND pp.h IS NOT NULL) ORDER BY p_brand, page_id, image_id) AS o FROM pp LEFT JOIN old USING (h)),
xr AS (SELECT *, CASE WHEN kind = 'url' THEN 'skipped' WHEN h IS NULL THEN 'failed' WHEN low IS NOT NULL THEN 'skipped' WHEN hit THEN 'success'
  WHEN h[1] IN ('0', '1', '2', '3') THEN 'failed' ELSE 'success' END AS status FROM xi)"""
_PGS = "pg AS (SELECT DISTINCT document_id FROM pc)"
ARTI = f"""{_PGS}, ac AS (SELECT document_id, count(*) AS image_count, count(*) FILTER (status = 'success') AS images_succeeded,
  count(*) FILTER (status = 'failed') AS images_failed, count(*) FILTER (status = 'skipped') AS images_skipped FROM xr GROUP BY 1),
ax AS (SELECT *, CASE WHEN images_succeeded = image_count THEN 'complete' WHEN images_succeeded > 0 THEN 'partial' WHEN images_skipped = image_count THEN 'skipped'
  ELSE 'failed' END AS status FROM ac)"""
_OPTS = "concat(CASE WHEN p_size % 5 = 0 THEN concat('p-', p_partkey % 200) ELSE concat(replace(p_name, ' ', '-'), '-', p_partkey) END, (['.png', '.pdf', '.PNG', '.xlsx'])[p_size % 4 + 1])"
_ASK = "concat(CASE WHEN p_size % 5 = 0 THEN upper(concat('p-', p_partkey % 200)) ELSE concat(replace(p_name, ' ', CASE WHEN p_size % 7 = 0 THEN '+' ELSE '-' END), '-', p_partkey) END, (['.png', '.pdf', '.PNG', '.xlsx'])[p_size % 4 + 1])"
SQL = {
    "previous_heading": with_corpus("SELECT document_id, line, in_line, nearby_heading FROM ir", REFS),
    "nearby_lines": with_corpus("SELECT document_id, line, in_line, sha256(context) AS context_sha FROM ir", REFS),
    "resolve_image_refs": with_corpus(
        f"""SELECT document_id, coalesce(loc, raw) AS source, CASE WHEN loc IS NULL THEN 'url' ELSE 'file' END AS source_kind,
        {_MIME.format(c="split_part(coalesce(loc, raw), '?', 1)")} AS mime_type FROM (SELECT document_id, raw, coalesce(
        (SELECT concat(rq.pid, '/attachments/', coalesce(max(name) FILTER (name = f), min(name))) FROM attachments_t a WHERE a.page_id = rq.pid AND lower(name) = lower(f) HAVING count(*) > 0),
        (SELECT concat(rq.pid2, '/attachments/', coalesce(max(name) FILTER (name = f), min(name))) FROM attachments_t a WHERE a.page_id = rq.pid2 AND lower(name) = lower(f) HAVING count(*) > 0)) AS loc
        FROM (SELECT concat('doc:', p_partkey) AS document_id, ((p_partkey + p_size % 2) % 200)::VARCHAR AS pid,
        CASE WHEN p_size % 3 = 0 THEN (p_partkey % 200)::VARCHAR END AS pid2, {_ASK} AS f, concat('https://wiki.example.com/',
        CASE WHEN p_size % 3 = 0 THEN concat('download/attachments/', p_partkey % 200, '/') ELSE 'files/' END, {_ASK}, '?version=', p_size) AS raw FROM part) rq)"""
    ),
    "discover_images": with_corpus("SELECT document_id, source_order, source, source_kind, mime_type, nearby_heading FROM fi", REFS, FOUND),
    "score_images": with_corpus(
        "SELECT document_id, source, score AS selection_score, array_to_string(CASE WHEN len(reasons) > 0 THEN reasons ELSE ['default_order'] END, '|') AS selection_reasons FROM i3",
        REFS, FOUND, SCOREI,
    ),
    "image_group_keys": with_corpus("SELECT document_id, source, group_key FROM i3", REFS, FOUND, SCOREI),
    "image_page_caps": with_corpus(
        "SELECT DISTINCT document_id, CASE WHEN rep THEN 12 WHEN page_id IN ('1', '5', '9') THEN 40 ELSE 20 END AS page_cap FROM i3", REFS, FOUND, SCOREI
    ),
    "image_rank": with_corpus("SELECT document_id, source, rank FROM i3", REFS, FOUND, SCOREI),
    "image_select": with_corpus("SELECT document_id, source, decision FROM dec", REFS, FOUND, SCOREI),
    "image_ids": with_corpus(
        """SELECT document_id, source, printf('image-%03d-%s', row_number() OVER (PARTITION BY document_id ORDER BY rank), substr(sha256(source), 1, 10)) AS image_id
        FROM dec WHERE decision = 'selected'""", REFS, FOUND, SCOREI,
    ),
    "omitted_image_inventory": with_corpus(
        "SELECT document_id, source, decision AS omitted_reason, score AS selection_score FROM dec WHERE decision <> 'selected'", REFS, FOUND, SCOREI
    ),
    "image_profile": f"WITH {PROF} SELECT image_id, h AS content_sha256, w AS width, ht AS height, low AS low_value_reason FROM pp",
    "image_cache_join": f"WITH {PROF} SELECT image_id, hit AS cache_hit, CASE WHEN hit THEN concat('old ', h) END AS ocr_text FROM xi",
    "extract_images": f"""WITH {PROF} SELECT image_id, status, CASE WHEN status <> 'success' THEN '' WHEN hit THEN concat('old ', h) ELSE concat('read ', h) END AS ocr_text,
        CASE WHEN kind = 'url' THEN 'remote_source_not_in_cache' WHEN h IS NULL THEN 'unreadable' WHEN low IS NOT NULL THEN 'low_value_visual' WHEN hit THEN NULL
        WHEN status = 'failed' THEN 'empty_answer' END AS error_type, hit OR (status = 'success' AND o > 1) AS cache_hit FROM xr""",
    "image_artifacts": f"WITH {PROF}, {ARTI} SELECT *, image_count AS listed FROM ax",
    "images_to_do": f"WITH {PROF}, {ARTI} SELECT document_id FROM ax WHERE status <> 'complete' OR split_part(document_id, ':', 2)::INT % 5 = 0",
    "visual_index_rows": f"WITH {PROF} SELECT document_id, image_id, status FROM xr",
    "image_dedupe_render": f"""WITH {ART}, r0 AS (SELECT concat(space_key, ':', page_id::INT % 40) AS document_id, page_id::INT * 10 + pos - 1 AS rank,
        concat(page_id, '/', image_id) AS image_id, h, repeat(concat(page_id, ' '), 30) AS ocr FROM im WHERE status = 'success'),
        r1 AS (SELECT *, h IS NOT NULL AND row_number() OVER (PARTITION BY document_id, h ORDER BY rank) > 1 AS rep FROM r0),
        r2 AS (SELECT *, row_number() OVER (PARTITION BY document_id, rep ORDER BY rank) AS k FROM r1)
        SELECT document_id, image_id, CASE WHEN rep THEN 'duplicate' WHEN k > 6 THEN 'truncated' ELSE 'shown' END AS outcome,
        CASE WHEN length(ocr) > 100 THEN length(rtrim(substr(ocr, 1, 100))) ELSE length(ocr) END AS chars, length(ocr) > 100 AS ocr_cut FROM r2""",
}
