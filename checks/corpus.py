"""A documents corpus derived from the given tables, in Spark and in SQL.

The tables hold invented prose without titles, labels or dates. Titles, labels, ancestors, dates,
links, image references and key-value lines are derived from the rows of ``documents``, ``pages``,
``customer`` and ``part``, so everything below grows with the tables. Texts are used whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswright.operators.profile import document_key

AS_OF = "2024-01-30T12:00:00Z"

KINDS = [
    "Payments runbook", "Incident review", "Release notes prod", "Meeting notes",
    "Service architecture overview", "Daily handover", "Draft support model", "Known error dev",
    "DR test", "Load testing result", "Archived guide", "Operational log", "API specification",
    "Migration roadmap qa",
]
LABELS = [
    "ops", "wip internal", "postmortem", "todo", "kafka queue", "grafana", "support team l2", "sev1",
    "deprecated", "prod", "getting started",
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(names: list[str], index: str, dialect: str) -> str:
    quoted = ", ".join("'" + n + "'" for n in names)
    if dialect == "spark":
        return f"element_at(array({quoted}), cast({index} as int) + 1)"
    return f"list_extract([{quoted}], ({index})::INT + 1)"


def _fields(d: str) -> dict[str, str]:
    """Column expressions both engines read alike; ``d`` picks the few that differ."""
    spark = d == "spark"
    nl = "'\\n'" if spark else "chr(10)"
    first_line = f"split_part(text, {nl}, 1)" if spark else f"split_part(text, {nl}, 1)"
    day = (
        "date_format(date_add(date'2020-06-01', cast((n * 37) % 1400 as int)), 'yyyy-MM-dd')"
        if spark
        else "strftime(date '2020-06-01' + ((n * 37) % 1400)::INT, '%Y-%m-%d')"
    )
    kind = _pick(KINDS, "n % 14", d)
    sha = "sha2(cast(n as string), 256)" if spark else "sha256(n::VARCHAR)"
    text_sha = "sha2(text, 256)" if spark else "sha256(text)"
    string = "string" if spark else "varchar"
    div = (lambda a, b: f"({a} div {b})") if spark else (lambda a, b: f"({a} // {b})")
    arr = (lambda *x: f"array({', '.join(x)})") if spark else (lambda *x: f"[{', '.join(x)}]")

    def anc(k: str) -> str:
        return f"concat({_pick(KINDS, k + ' % 14', d)}, ' ', {k})"

    parent, root = div("n", 10), div("n", 100)
    empty = "cast(array() as array<string>)" if spark else "[]::VARCHAR[]"
    return {
        "page_id": f"cast(n as {string})",
        "title": (
            f"case n % 3 when 0 then concat({kind}, ' installation guide for the shared region ', n % 9) "
            f"when 1 then concat({kind}, ' ', substr({first_line}, 1, 40)) "
            f"else substr({first_line}, 1, 80) end"
        ),
        "status": "case when n % 13 = 0 then 'archived' when n % 17 = 0 then null else 'current' end",
        "updated_at": (
            f"case when n % 19 = 0 then 'not a date' when n % 23 = 0 then null else concat({day}, "
            "case n % 3 when 0 then 'T08:30:00Z' when 1 then 'T08:30:00+02:00' else 'T08:30:00' end) end"
        ),
        "labels": (
            f"case when n % 4 = 0 then {empty} else "
            + arr(_pick(LABELS, "n % 11", d), _pick(LABELS, "(n * 7) % 11", d))
            + " end"
        ),
        "ancestor_ids": (
            f"case when n = 0 then {empty} when n < 10 then {arr(f'cast({parent} as {string})')} "
            f"else {arr(f'cast({root} as {string})', f'cast({parent} as {string})')} end"
        ),
        "ancestor_titles": (
            f"case when n = 0 then {empty} when n < 10 then {arr(anc(parent))} "
            f"else {arr(anc(root), anc(parent))} end"
        ),
        "body": (
            f"concat(text, case when n % 2 = 0 then concat({nl}, 'Service owner: ', coalesce(c_name, 'nobody'), "
            f"{nl}, 'Support group - ', coalesce(c_mktsegment, 'none'), ' team; ask support') else '' end, "
            f"case when n % 5 = 1 then concat({nl}, 'The queue depends on Supplier ', n % 50, {nl}, "
            f"'Check the dashboard: board ', n % 7, ' then restart and validate') else '' end, "
            f"case when n % 7 = 0 then concat({nl}, 'Valid until 30 Feb 2031 or 12 March 20', 10 + n % 30, "
            f"' or 2023-1-', n % 40) else '' end, "
            f"case when n % 25 = 0 then concat({nl}, 'password = hunter', n, ' api_key: k', n, ' AKIA', "
            f"upper(substr({sha}, 1, 16)), ' mail ops', n, '@corp.example or a@b.example.org') else '' end, "
            f"case when n % 31 = 0 then concat({nl}, 'see datadog client EMP-AB12', n) else '' end)"
        ),
        "text_sha": text_sha,
        "attachment_stub": f"concat('/download/attachments/', n, '/Manual ', n % 5, '.pdf')",
    }


def _markdown(d: str) -> str:
    spark = d == "spark"
    nl = "'\\n'" if spark else "chr(10)"
    images = (
        "array_join(transform(sequence(1, cast(n % 9 as int)), k -> "
        "concat('![Dashboard ', k, '](attachments/p-', (n + k) % 200, '.png)')), ' ')"
        if spark
        else "array_to_string(list_transform(range(1, (n % 9)::INT + 1), lambda k: "
        "concat('![Dashboard ', k, '](attachments/p-', (n + k) % 200, '.png)')), ' ')"
    )
    return (
        f"concat(case when n % 5 = 0 then concat('---', {nl}, 'id: ', n, {nl}, '---', {nl}) else '' end, "
        f"'# ', title, {nl}, {nl}, "
        f"case when n % 29 = 0 then 'No exportable body content' else '' end, "
        f"{nl}, '## Overview of ', space_key, {nl}, text, {nl}, "
        f"case when n % 9 > 0 and n % 4 = 1 then concat({nl}, '### Charts', {nl}, {images}, {nl}) else '' end, "
        f"case when n % 8 = 3 then concat({nl}, '![](https://img.example.com/icons/logo-', n % 6, '.png?v=1)', {nl}) "
        "else '' end, "
        f"case when n % 50 = 0 then concat({nl}, '| ', repeat('cell ', 300), '|', {nl}) else '' end)"
    )


def documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    owners = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    raw = docs.join(owners, docs["doc_id"] == owners["c_custkey"], "left").select(
        F.col("doc_id").alias("n"), "text", F.col("lang").alias("space_key"), "c_name", "c_mktsegment"
    )
    f = _fields("spark")
    named = raw.select(
        "n",
        "space_key",
        *[F.expr(f[k]).alias(k) for k in ("page_id", "title", "status", "updated_at", "labels")],
        F.expr(f["ancestor_ids"]).alias("ancestor_ids"),
        F.expr(f["ancestor_titles"]).alias("ancestor_titles"),
        F.expr(f["text_sha"]).alias("text_sha"),
        F.expr(f["attachment_stub"]).alias("attachment_stub"),
        F.expr(f["body"]).alias("text"),
    )
    return document_key(
        named.select(
            "n", "page_id", "space_key", "title", "status", "updated_at", "labels", "text",
            "attachment_stub",
            F.expr("concat('https://wiki.example.com/', space_key, '/', page_id)").alias("url"),
            F.transform(
                F.arrays_zip("ancestor_ids", "ancestor_titles"),
                lambda a: F.struct(a["ancestor_ids"].alias("id"), a["ancestor_titles"].alias("title")),
            ).alias("ancestors"),
            F.expr(_markdown("spark")).alias("markdown"),
            F.struct(
                F.when(F.expr("n % 3 = 0"), F.col("text_sha")).otherwise(F.lit("")).alias("markdown_sha256"),
                F.when(F.expr("n % 37 <> 1"), F.col("text_sha")).alias("text_sha256"),
                F.lit(None).cast("string").alias("storage_sha256"),
                F.lit(None).cast("string").alias("export_view_sha256"),
            ).alias("content_hashes"),
        )
    )


LINK_TYPE = "array<struct<type:string,href:string,text:string,target_title:string>>"


def links(spark: SparkSession, sf: str) -> DataFrame:
    """(n, links) from the anchors of ``pages``."""
    html = table(spark, sf, "pages").select("page_id", "html")
    pattern = """'<a href="([^"]*)">([^<]*)</a>'"""
    found = html.select(
        F.col("page_id").alias("n"),
        F.expr(f"regexp_extract_all(html, {pattern}, 1)").alias("h"),
        F.expr(f"regexp_extract_all(html, {pattern}, 2)").alias("t"),
    )
    return found.select(
        "n",
        F.expr(
            "transform(arrays_zip(h, t), l -> named_struct('type', 'external', 'href', l.h, 'text', l.t, "
            "'target_title', cast(null as string)))"
        ).alias("links"),
    )


def attachments(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, name, length) derived from ``part``."""
    return table(spark, sf, "part").selectExpr(
        "cast(p_partkey % 200 as string) page_id",
        "concat(case when p_size % 5 = 0 then concat('p-', p_partkey % 200) else "
        "concat(replace(p_name, ' ', '-'), '-', p_partkey) end, "
        "element_at(array('.png', '.pdf', '.PNG', '.xlsx'), p_size % 4 + 1)) name",
        "cast(p_size * 100 as bigint) length",
    )


def pages(spark: SparkSession, sf: str, *, with_attachments: bool = False) -> DataFrame:
    """The page rows every per-page operator reads."""
    extra = (
        "array(named_struct('type', 'attachment', 'href', concat(attachment_stub, '?v=1'), 'text', "
        "cast(null as string), 'target_title', cast(null as string)), "
        "named_struct('type', 'external', 'href', concat('https://jira.example.com/browse/X-', n), "
        "'text', 'here', 'target_title', cast(null as string)), "
        "named_struct('type', 'external', 'href', concat('mailto:team', n % 10, '@corp.example'), "
        "'text', 'Mail us', 'target_title', cast(null as string)), "
        "named_struct('type', 'page', 'href', concat('/wiki/', n div 2), 'text', 'x', "
        "'target_title', concat('Service catalogue ', n % 20)))"
    )
    docs = documents(spark, sf)
    joined = docs.join(links(spark, sf), "n", "left").withColumn(
        "links",
        F.expr(
            f"concat(coalesce(links, cast(array() as {LINK_TYPE})), "
            f"case when n % 6 = 0 then {extra} else cast(array() as {LINK_TYPE}) end)"
        ),
    )
    if not with_attachments:
        return joined.withColumn("attachment_names", F.expr("cast(array() as array<string>)"))
    names = attachments(spark, sf).groupBy("page_id").agg(
        F.array_sort(F.collect_set("name")).alias("attachment_names")
    )
    return joined.join(names, "page_id", "left").withColumn(
        "attachment_names", F.expr("coalesce(attachment_names, cast(array() as array<string>))")
    )


# ---- the same in SQL --------------------------------------------------------------------------


def corpus_sql() -> str:
    """``WITH`` list defining attachments_t, links_t and corpus."""
    f = _fields("duckdb")
    pattern = """'<a href="([^"]*)">([^<]*)</a>'"""
    return f"""
raw AS (SELECT doc_id AS n, text, lang AS space_key, c_name, c_mktsegment
        FROM documents LEFT JOIN customer ON c_custkey = doc_id),
named AS (SELECT n, space_key, {f['page_id']} AS page_id, {f['title']} AS title, {f['status']} AS status,
        {f['updated_at']} AS updated_at, {f['labels']} AS labels, {f['ancestor_ids']} AS ancestor_ids,
        {f['ancestor_titles']} AS ancestor_titles, {f['text_sha']} AS text_sha,
        {f['attachment_stub']} AS attachment_stub, {f['body']} AS text FROM raw),
attachments_t AS (SELECT DISTINCT (p_partkey % 200)::VARCHAR AS page_id,
        concat(CASE WHEN p_size % 5 = 0 THEN concat('p-', p_partkey % 200)
               ELSE concat(replace(p_name, ' ', '-'), '-', p_partkey) END,
               list_extract(['.png', '.pdf', '.PNG', '.xlsx'], p_size % 4 + 1)) AS name FROM part),
base AS (SELECT named.*, {_markdown('duckdb')} AS markdown,
        concat('https://wiki.example.com/', space_key, '/', page_id) AS url,
        concat_ws(':', 'doc', space_key, page_id) AS document_id,
        concat('sha256:', CASE WHEN n % 3 = 0 OR n % 37 <> 1 THEN text_sha ELSE 'unknown' END)
          AS source_content_hash FROM named),
page_links AS (SELECT page_id AS n, regexp_extract_all(html, {pattern}, 1) AS h,
        regexp_extract_all(html, {pattern}, 2) AS t FROM pages),
links_t AS (
  SELECT base.n, i AS pos, 'external' AS type, h[i] AS href, t[i] AS text, NULL::VARCHAR AS target_title
    FROM base JOIN page_links USING (n), unnest(range(1, len(h) + 1)) u(i)
  UNION ALL SELECT n, 100001, 'attachment', concat(attachment_stub, '?v=1'), NULL, NULL FROM base WHERE n % 6 = 0
  UNION ALL SELECT n, 100002, 'external', concat('https://jira.example.com/browse/X-', n), 'here', NULL
    FROM base WHERE n % 6 = 0
  UNION ALL SELECT n, 100003, 'external', concat('mailto:team', n % 10, '@corp.example'), 'Mail us', NULL
    FROM base WHERE n % 6 = 0
  UNION ALL SELECT n, 100004, 'page', concat('/wiki/', n // 2), 'x', concat('Service catalogue ', n % 20)
    FROM base WHERE n % 6 = 0),
link_agg AS (SELECT n, count(*) AS link_count, string_agg(coalesce(href, ''), ' ' ORDER BY pos) AS hrefs
    FROM links_t GROUP BY n),
corpus AS (SELECT base.*, coalesce(link_count, 0) AS link_count, coalesce(hrefs, '') AS hrefs
    FROM base LEFT JOIN link_agg USING (n))"""


def with_corpus(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([corpus_sql(), *ctes]) + "\n" + select


# ---- index rows derived by rule (for the report operators) ------------------------------------

DOCUMENT_TYPES = [
    "approved_runbook", "runbook", "architecture", "design", "support_model", "incident", "rca",
    "knowledge_article", "known_error", "migration", "onboarding", "meeting_notes", "project_plan",
    "change_record", "reference", "archive", "unknown",
]


def _index_fields(d: str) -> dict[str, str]:
    spark = d == "spark"
    arr = (lambda *x: f"array({', '.join(x)})") if spark else (lambda *x: f"[{', '.join(x)}]")
    flags = arr(
        "case when n % 3 = 0 then 'manual_review_required' end",
        "case when n % 10 = 0 then 'future_dated' end",
        "case when n % 6 = 1 then 'visual_content_missing' end",
        "case when n % 8 = 2 then 'attachment_content_missing' end",
        "case when n % 9 = 4 then 'contains_email_addresses' end",
        "case when n % 14 = 3 then 'requires_restricted_audience' end",
    )
    return {
        "document_type": _pick(DOCUMENT_TYPES, "n % 17", d),
        "document_subtype": "case when n % 4 = 0 then 'faq' end",
        "content_availability": "case n % 20 when 0 then 'empty' when 1 then 'thin' else 'normal' end",
        "status_flags": (
            f"case when n % 11 = 0 then {arr(chr(39) + 'archived' + chr(39), chr(39) + 'deprecated' + chr(39))} "
            f"when n % 7 = 0 then {arr(chr(39) + 'stale' + chr(39))} else {arr(chr(39) + 'current' + chr(39))} end"
        ),
        "review_flags": f"array_compact({flags})" if spark else f"list_filter({flags}, lambda x: x IS NOT NULL)",
        "audience": "case when n % 14 = 3 then 'restricted_internal' else 'internal' end",
        "sensitivity": "case when n % 9 = 4 then 'restricted' when n % 20 = 5 then 'public' else 'internal' end",
        "outbound_link_count": "n % 13",
        "attachment_count": "n % 5",
        "word_count": "length(text) % 5000",
        "source_updated_at": "updated_at",
        "page_role": "case n % 3 when 0 then 'leaf_page' when 1 then 'index_page' else 'runbook_detail' end",
    }


INDEX_NAMES = [
    "n", "document_id", "page_id", "space_key", "title", "url", "source_content_hash",
]


def index_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    f = _index_fields("spark")
    return docs.select(*INDEX_NAMES, *[F.expr(e).alias(k) for k, e in f.items()])


def index_sql() -> str:
    f = _index_fields("duckdb")
    cols = ", ".join(f"{e} AS {k}" for k, e in f.items())
    return f"idx AS (SELECT {', '.join(INDEX_NAMES)}, {cols} FROM base)"


def quality_table(spark: SparkSession, sf: str) -> DataFrame:
    """Quality rows of the labelled documents."""
    docs = documents(spark, sf).select("n", "document_id", "page_id", "space_key")
    return docs.join(table(spark, sf, "labels"), F.col("n") == F.col("doc_id")).select(
        "document_id", "page_id", "space_key", F.expr("quality * 50 + n % 50").alias("quality_score")
    )


QUALITY_SQL = (
    "qlt AS (SELECT document_id, base.page_id, space_key, quality * 50 + n % 50 AS quality_score "
    "FROM base JOIN labels ON doc_id = n)"
)
