"""Redaction, refresh, runs, validation, scans, sinks, export."""

from __future__ import annotations

import uuid

from checks.corpus import (
    AS_OF, INDEX_NAMES, attachments, documents, index_rows, index_sql, pages, table, with_corpus,
)
from checks.q_classify import ATT, J, any_sql, q
from checks.q_extract import NORM
from checks.q_profile import BODY_SQL
from checks.q_reports import FAIL, USE, enriched_rule, failures, usage
from corpuswright import fixed_values as fv
from corpuswright import schemas
from corpuswright.operators import export as xp
from corpuswright.operators import incremental as inc
from corpuswright.operators import redact as rd
from corpuswright.operators import runs as rn
from corpuswright.operators import validation as va
from corpuswright.session import shared_dir
from corpuswright.sources import scan, sinks
from pyspark.sql import functions as F

# patterns that occur in the given texts, behind the default ones
PATTERNS = fv.SECRET_PATTERNS + [("quoted_token", r"token = \"[0-9a-f]{20,}\""), ("ipv4", r"\b\d{1,3}(?:\.\d{1,3}){3}\b")]


def scratch(spark) -> str:
    return f"{shared_dir(spark)}/corpuswright-{uuid.uuid4().hex}"


# ---- derived exports ---------------------------------------------------------------------------


def manifest(spark, sf):
    return documents(spark, sf).selectExpr(
        "concat('pages/', page_id, '/clean.md') markdown_path", "page_id", "concat('pages/', page_id) path", "space_key",
        "case when n % 23 = 5 then 'failed' else 'success' end status", "title", "updated_at", "cast(n % 7 as int) version", "n",
    )


def manifest_lines(spark, sf):
    """The manifest as JSON lines, some of them damaged or blank."""
    rows = manifest(spark, sf).drop("n")
    packed = F.to_json(F.struct(*[F.col(c) for c in rows.columns]))
    n = F.col("page_id").cast("bigint")
    return rows.select(
        F.explode(
            F.array(
                F.when(n % 41 == 3, F.substring(packed, 1, 20)).when(n % 43 == 2, F.lit("[1, 2]")).otherwise(packed),
                F.when(n % 10 == 0, F.lit("  ")).otherwise(F.lit("")),
            )
        ).alias("value")
    )


def files(spark, sf):
    """Files present: every required one but some."""
    names = ["metadata.json", "clean.md", "text.txt", "links.json", "conversion.json"]
    return manifest(spark, sf).select("n", F.col("path").alias("folder"), F.posexplode(F.array(*[F.lit(x) for x in names])).alias("k", "name")).where(
        "n % 53 <> 7 and (n + k) % 31 <> 0"
    ).select(F.concat_ws("/", "folder", "name").alias("path"))


def metadata(spark, sf):
    lines = documents(spark, sf).select(
        F.concat(F.lit("pages/"), "page_id").alias("folder"),
        F.when(F.expr("n % 47 = 11"), F.lit("{broken")).otherwise(
            F.to_json(
                F.struct(
                    F.expr("case when n % 37 = 4 then concat(page_id, 'x') else page_id end").alias("page_id"),
                    "space_key", "title", "content_hashes",
                )
            )
        ).alias("value"),
    )
    return scan.parse_json_lines(lines, schemas.METADATA)


def links_files(spark, sf):
    lines = documents(spark, sf).select(
        F.concat(F.lit("pages/"), "page_id").alias("folder"),
        F.when(F.expr("n % 59 = 1"), F.lit("not json")).otherwise(F.lit('{"links": []}')).alias("value"),
    )
    return scan.parse_json_lines(lines, schemas.LINKS)


def conversion(spark, sf):
    lines = documents(spark, sf).select(
        F.concat(F.lit("pages/"), "page_id").alias("folder"),
        F.expr("concat('{\"warnings\": [', case n % 9 when 0 then '\"a\"' when 1 then '\"a\",\"b\"' else '' end, ']}')").alias("value"),
    )
    return scan.parse_json_lines(lines, schemas.CONVERSION)


def errors(spark, sf):
    return table(spark, sf, "events").where("event_type = 'error'").selectExpr(
        "'export' operation", "cast(user_id as string) page_id", "props error", "'' timestamp"
    )


def issues(spark, sf):
    return va.validate_corpus(
        manifest(spark, sf), files(spark, sf), metadata(spark, sf), links_files(spark, sf), conversion(spark, sf), errors(spark, sf)
    )


def _assembled(spark, sf):
    md = documents(spark, sf).where("n % 31 <> 0").select(F.concat(F.lit("pages/"), "page_id").alias("folder"), "markdown")
    tx_ = documents(spark, sf).select(F.concat(F.lit("pages/"), "page_id").alias("folder"), "text")
    meta = scan.good_rows(metadata(spark, sf)).select("folder", "page_id", "title")
    done = va.assemble_pages(manifest(spark, sf), meta, md, tx_)
    return done.select("folder", "page_id", "title", F.length("text").alias("chars"))


# ---- refresh -----------------------------------------------------------------------------------


def signatures(spark, sf):
    """Signatures of orders now, and as stored by an earlier run (some changed, some absent)."""
    now = table(spark, sf, "orders").select(
        F.expr("concat('doc:', o_orderkey)").alias("document_id"), F.expr("o_orderpriority").alias("document_type"),
        F.expr("concat('sha256:', sha2(concat(o_custkey, '|', o_orderstatus), 256))").alias("source_content_hash"), F.col("o_orderkey").alias("k"),
    )
    stored = now.where("k % 10 <> 3").select(
        "document_id", "document_type",
        F.expr("case when k % 7 = 0 then 'sha256:old' else source_content_hash end").alias("source_content_hash"),
        F.expr("case when k % 11 = 0 then null else 'v1' end").alias("prompt_version"),
        F.expr("case when k % 13 = 0 then 'other' else 'none' end").alias("provider"),
        F.lit("none").alias("model_or_deployment"), F.lit("keywords,themes").alias("tasks"),
        F.lit(CONFIG).alias("enrichment_config_hash"), F.lit("run-1").alias("run_id"), F.lit("t1").alias("generated_at"), F.lit("d").alias("dataset_name"),
    )
    return now, stored


CONFIG = inc.config_signature({"scoring": {"a": 1}, "prompt_version": "v1"})
EXPECTED = {
    "source_content_hash": F.col, "prompt_version": "v1", "provider": "none", "model_or_deployment": "none",
    "tasks": "keywords,themes", "enrichment_config_hash": CONFIG,
}


def _refresh(spark, sf, document_type=None):
    now, stored = signatures(spark, sf)
    expected = {**EXPECTED, "source_content_hash": F.col("source_content_hash")}
    carried, todo = inc.changed_only(now, stored, expected)
    carried = inc.refreshed(carried, run_id="run-2", generated_at="t2", dataset_name="d")
    todo = inc.filter_document_type(todo, document_type)
    return carried.select("document_id", "document_type", "run_id", F.lit("carried").alias("branch")).unionByName(
        todo.select("document_id", "document_type", F.lit("run-2").alias("run_id"), F.lit("recomputed").alias("branch"))
    )


# ---- runs --------------------------------------------------------------------------------------


def runs(spark, sf):
    """Runs: hours of events, their command from the type."""
    return table(spark, sf, "events").groupBy(
        F.expr("concat('run-', lpad(user_id, 4, '0'), '-', date_format(ts, 'yyyyMMdd'))").alias("run_id"),
        F.expr("element_at(map('view', 'enrich', 'click', 'extract-visuals', 'error', 'report', 'signup', 'validate', 'purchase', 'enrich'), event_type)").alias("command"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def run_pages(spark, sf):
    return table(spark, sf, "events").where("event_type in ('view', 'click')").selectExpr(
        "concat('run-', lpad(user_id % 7, 2, '0')) run_id", "case when event_type = 'view' then 'processed' else 'skipped' end status"
    )


def _run_tables(spark, sf):
    """Write run tables, read them back for the selected runs."""
    root = scratch(spark)
    f = failures(spark, sf).selectExpr(
        "run_id", "page_id", "stage", "error_type", "'d' dataset_name", "cast(null as map<string,string>) error_context"
    )
    u = usage(spark, sf).selectExpr("run_id", "page_id", "task", "provider", "model", "input_tokens", "output_tokens", "cached", "retries", "'d' dataset_name")
    summary = u.select("run_id").distinct().selectExpr(
        "run_id", "case when run_id < 'run-04' then 'enrich' else 'report' end command", "'d' dataset_name",
        "case when run_id = 'run-02' then '/other' when run_id = 'run-01' then null else '/corpus' end cache_path",
    )
    sinks.write_run_artifacts(root, run_summary=summary, page_failures=f, model_usage=u)
    return root


def _history(spark, sf):
    root = _run_tables(spark, sf)
    return root, scan.scan_run_history(spark, root, dataset_name="d", cache_path="/corpus")


def _scan_usage(spark, sf):
    root, history = _history(spark, sf)
    chosen = rn.select_runs(history, all_runs=True)
    return scan.scan_run_usage(spark, root, chosen, dataset_name="d").groupBy("run_id", "task").agg(F.count(F.lit(1)).alias("calls"))


def _scan_failures(spark, sf):
    root, history = _history(spark, sf)
    chosen = rn.select_runs(history, run_ids=["run-00", "run-03"])
    return scan.scan_run_failures(spark, root, chosen, dataset_name="d").select("run_id", "page_id", "stage", "error_type")


def _round_trip(spark, sf, name):
    """Write rows with a sink and read them back with the matching scan."""
    root = scratch(spark)
    if name == "enrichments":
        rows = enriched_rule(spark, sf).select("document_id", "space_key", "document_type", "review_flags")
        sinks.write_enrichments(rows, root)
        return scan.scan_enrichments(spark, root)
    if name == "index":
        sinks.write_index_tables({"document_index": index_rows(spark, sf)}, root, run_id="r", dataset_name="d")
        return scan.scan_index_tables(spark, root)["document_index"].select("document_id", "run_id", "document_type", "status_flags", "word_count")
    if name == "export":
        rendered = documents(spark, sf).select(
            "space_key", "document_id", xp.export_path("d").alias("path"), F.sha2("markdown", 256).alias("content")
        )
        sinks.write_document_export(rendered, root)
        return spark.read.parquet(root)
    raise ValueError(name)


def _scan_manifest(spark, sf):
    root = scratch(spark)
    manifest_lines(spark, sf).write.text(f"{root}/manifest.jsonl")
    rows = scan.scan_manifest(spark, root)
    return rows.select(
        "page_id", "space_key", "status", "title", "version", F.col("_corrupt").isNotNull().alias("corrupt")
    )


def _scan_errors(spark, sf):
    root = scratch(spark)
    errors(spark, sf).select(F.to_json(F.struct("operation", "page_id", "error", "timestamp")).alias("value")).write.text(f"{root}/errors.jsonl")
    return scan.scan_export_errors(spark, root).groupBy("page_id", "error").agg(F.count(F.lit(1)).alias("n"))


def _scan_summary(spark, sf):
    root = scratch(spark)
    docs = documents(spark, sf).groupBy("space_key").agg(F.count(F.lit(1)).cast("int").alias("n"))
    packed = docs.agg(F.map_from_entries(F.collect_list(F.struct("space_key", "n"))).alias("spaces"), F.sum("n").cast("int").alias("total_pages"))
    packed.select(F.to_json(F.struct("spaces", "total_pages")).alias("value")).coalesce(1).write.text(f"{root}/manifest.summary.json")
    rows = scan.scan_manifest_summary(spark, root)
    return rows.select("total_pages", F.explode("spaces").alias("space_key", "pages"))


def _scan_dataset(spark, sf):
    root = scratch(spark)
    head = documents(spark, sf).agg(
        F.lit("wiki").alias("source"), F.concat(F.lit("corpus-"), F.count(F.lit(1)).cast("string")).alias("dataset_name"),
        F.max("updated_at").alias("updated_at"),
    )
    head.select(F.to_json(F.struct("source", "dataset_name", "updated_at")).alias("value")).coalesce(1).write.text(f"{root}/dataset.json")
    return scan.scan_dataset(spark, root).select("source", "dataset_name", "updated_at")


def _attachments(spark, sf):
    paths = attachments(spark, sf).select(F.concat_ws("/", F.lit("pages"), "page_id", F.lit("attachments"), "name").alias("path"), "length")
    extra = documents(spark, sf).select(
        F.explode(F.expr("array(concat('pages/', page_id, '/clean.md'), concat('pages/', page_id, '/attachments/manifest.json'))")).alias("path"),
        F.lit(1).cast("bigint").alias("length"),
    )
    return scan.attachment_names(scan.scan_attachments(paths.unionByName(extra)))


def _export_files(spark, sf):
    """Exported files of earlier runs: renamed, stale and foreign ones among them."""
    return documents(spark, sf).select(
        F.explode(
            F.expr(
                "filter(array("
                "named_struct('path', concat('out/', space_key, '/', page_id, '-a.md'), 'modified', n % 5), "
                "case when n % 6 = 0 then named_struct('path', concat('out/', space_key, '/', page_id, '-b.md'), 'modified', n % 7) end, "
                "case when n % 9 = 0 then named_struct('path', concat('out/', space_key, '/', page_id + 1000000, '-c.md'), 'modified', 1L) end, "
                "case when n % 11 = 0 then named_struct('path', concat('out/', space_key, '/readme', page_id, '.md'), 'modified', 1L) end), x -> x is not null)"
            )
        ).alias("f")
    ).select("f.path", "f.modified")


def _violations(spark, sf):
    df = documents(spark, sf).selectExpr(
        "document_id", "(n % 120) / 100.0D confidence", "named_struct('overall_score', cast(n % 130 as int)) quality",
        "case when n % 8 = 0 then 'novel' else 'runbook' end document_type",
    )
    return va.constraint_violations(df, ranges={"confidence": (0, 1), "quality.overall_score": (0, 100)}).select("document_id", "column")


def _signature_rows(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", inc.row_signature(F.struct("o_custkey", "o_orderstatus")).alias("sig"))
    return rows.withColumn("config", F.lit(CONFIG))


def _warning_rows(spark, sf):
    red = rd.redact_secrets(documents(spark, sf), patterns=PATTERNS)
    return rn.warning_rows(red, "redaction_warnings", run_id="r", stage="export").select("document_id", "warning_type", "stage")


def _failure_rows(spark, sf):
    red = rd.redact_secrets(documents(spark, sf), patterns=PATTERNS, action="fail").where("redaction_failed")
    return rn.failure_rows(
        red, run_id="r", stage="export", error_type="ValueError", message=F.array_join("redaction_warnings", ", "), retryable=False
    ).select("document_id", "stage", "error_type", "message")


QUERIES = {
    "redact_secrets": lambda s, d: rd.redact_secrets(documents(s, d), patterns=PATTERNS).select(
        "document_id", F.sha2("text", 256).alias("clean_sha"), "redaction_warnings"
    ),
    "failure_rows": _failure_rows,
    "warning_rows": _warning_rows,
    "changed_only": lambda s, d: _refresh(s, d),
    "filter_document_type": lambda s, d: _refresh(s, d, "1-URGENT"),
    "config_signature": _signature_rows,
    "select_pages": lambda s, d: inc.select_pages(
        manifest(s, d).withColumn("manifest_status", F.col("status")), space="en", limit=40
    ).select("page_id", "space_key"),
    "latest_run_per_command": lambda s, d: rn.latest_run_per_command(runs(s, d)),
    "select_runs": lambda s, d: rn.select_runs(runs(s, d), all_runs=True),
    "run_counts": lambda s, d: rn.run_counts(run_pages(s, d), failures(s, d), usage(s, d)),
    "scan_run_history": lambda s, d: _history(s, d)[1].select("run_id", "command"),
    "scan_run_usage": _scan_usage,
    "scan_run_failures": _scan_failures,
    "write_enrichments": lambda s, d: _round_trip(s, d, "enrichments"),
    "write_index_tables": lambda s, d: _round_trip(s, d, "index"),
    "write_document_export": lambda s, d: _round_trip(s, d, "export"),
    "scan_manifest": _scan_manifest,
    "scan_export_errors": _scan_errors,
    "scan_manifest_summary": _scan_summary,
    "scan_dataset": _scan_dataset,
    "scan_attachments": _attachments,
    "assemble_pages": _assembled,
    "page_id_mismatch": lambda s, d: va.page_id_mismatch(manifest(s, d), scan.good_rows(metadata(s, d))),
    "validate_corpus": issues,
    "validation_summary": lambda s, d: va.validation_summary(manifest(s, d), issues(s, d), errors(s, d)),
    "constraint_violations": _violations,
    "export_eligibility": lambda s, d: xp.export_eligibility(
        index_rows(s, d), audiences=["restricted_internal"], sensitivities=["restricted"], availability=["empty"],
        review_flags=["future_dated", "visual_content_missing"],
    ).select("document_id", "exclusion_reasons", "eligible"),
    "low_value_links": lambda s, d: xp.low_value_links(pages(s, d)).groupBy("document_id", "low_value").agg(F.count(F.lit(1)).alias("links")),
    "source_link_ranking": lambda s, d: xp.source_link_ranking(pages(s, d)),
    "export_metadata": lambda s, d: xp.export_metadata(
        index_rows(s, d).selectExpr("*", "source_updated_at updated_at", "'good' quality_band", "n % 2 = 0 historical", "'current' currentness"),
        dataset_name="d",
    ).select("document_id", "metadata_line"),
    "export_audit": lambda s, d: xp.export_audit(_export_files(s, d), index_rows(s, d)),
}


def secrets_ctes() -> str:
    """One CTE per pattern, each reading the text the one before it left."""
    out, prev = [], "(SELECT document_id, text AS t, []::VARCHAR[] AS ws FROM base)"
    for i, (name, pattern) in enumerate(PATTERNS):
        p = q(pattern)
        out.append(
            f"x{i} AS (SELECT document_id, regexp_replace(t, {p}, '[REDACTED]', 'g') AS t, CASE WHEN regexp_matches(t, {p}) THEN "
            f"list_append(ws, concat('redaction_match:{name}:', len(regexp_extract_all(t, {p})))) ELSE ws END AS ws FROM {prev})"
        )
        prev = f"x{i}"
    # counted on the untouched text, as the fail action does
    raw = ", ".join(
        f"CASE WHEN regexp_matches(text, {q(p)}) THEN concat('redaction_match:{n}:', len(regexp_extract_all(text, {q(p)}))) END" for n, p in PATTERNS
    )
    out.append(f"red AS (SELECT * FROM {prev})")
    out.append(f"redf AS (SELECT document_id, list_filter([{raw}], lambda x: x IS NOT NULL) AS ws FROM base)")
    return ",\n".join(out)


SIGS = f"""
nw AS (SELECT concat('doc:', o_orderkey) AS document_id, o_orderpriority AS document_type, o_orderkey AS k FROM orders),
same AS (SELECT document_id FROM nw WHERE k % 10 <> 3 AND k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0)"""


def _refresh_sql(where: str) -> str:
    return f"""WITH {SIGS} SELECT document_id, document_type, 'run-2' AS run_id, 'carried' AS branch FROM nw WHERE document_id IN (SELECT document_id FROM same)
        UNION ALL SELECT document_id, document_type, 'run-2', 'recomputed' FROM nw WHERE document_id NOT IN (SELECT document_id FROM same) {where}"""


RUNS = """rn AS (SELECT concat('run-', lpad(user_id::VARCHAR, 4, '0'), '-', strftime(ts, '%Y%m%d')) AS run_id, CASE event_type WHEN 'view' THEN 'enrich'
  WHEN 'purchase' THEN 'enrich' WHEN 'click' THEN 'extract-visuals' WHEN 'error' THEN 'report' ELSE 'validate' END AS command, count(*) AS rows
  FROM events GROUP BY ALL)"""
MAN = """mf AS (SELECT n, page_id, concat('pages/', page_id) AS path, space_key, CASE WHEN n % 23 = 5 THEN 'failed' ELSE 'success' END AS status, title,
  updated_at, n % 7 AS version FROM base)"""
ISS = """
ok AS (SELECT * FROM mf WHERE status = 'success'),
nm AS (SELECT * FROM (VALUES (0, 'metadata.json', 'metadata_missing'), (1, 'clean.md', 'markdown_missing'), (2, 'text.txt', 'text_missing'),
  (3, 'links.json', 'links_missing'), (4, 'conversion.json', 'conversion_missing')) v(k, f, code)),
iss AS (
  SELECT 'error' AS level, code, concat('Required page artifact missing: ', path, '/', f) AS message, concat(path, '/', f) AS path, page_id
    FROM ok, nm WHERE n % 53 = 7 OR (n + k) % 31 = 0
  UNION ALL SELECT 'error', 'page_folder_missing', concat('Required page artifact missing: ', path), path, page_id FROM ok WHERE n % 53 = 7
  UNION ALL SELECT 'error', 'metadata_invalid', 'metadata.json is invalid', concat(path, '/metadata.json'), page_id FROM ok WHERE n % 47 = 11
  UNION ALL SELECT 'error', 'links_invalid', 'links.json is invalid', concat(path, '/links.json'), page_id FROM ok WHERE n % 59 = 1
  UNION ALL SELECT 'error', 'page_id_mismatch', concat('metadata page_id ', page_id, 'x does not match manifest ', page_id), concat(path, '/metadata.json'),
    page_id FROM ok WHERE n % 37 = 4 AND n % 47 <> 11
  UNION ALL SELECT 'warning', 'markdown_hash_missing', 'metadata content_hashes.markdown_sha256 is missing', concat(path, '/metadata.json'), page_id
    FROM ok WHERE n % 3 <> 0 AND n % 47 <> 11
  UNION ALL SELECT 'warning', 'conversion_warnings_present', concat('conversion.json contains ', n % 9 + 1, ' warning(s)'), concat(path, '/conversion.json'),
    page_id FROM ok WHERE n % 9 IN (0, 1)
  UNION ALL SELECT 'warning', 'export_errors_present', concat('errors.jsonl contains ', count(*), ' exporter error(s)'), 'errors.jsonl', NULL FROM events
    WHERE event_type = 'error' HAVING count(*) > 0)"""
_LOWV = "(starts_with(href, 'mailto:') OR starts_with(href, '#') OR " + any_sql("lower(concat(coalesce(text, ''), ' ', href))", fv.LOW_VALUE_LINK_TERMS) + ")"
LINKR = f"""
lr0 AS (SELECT document_id, pos, coalesce(l.text, '') AS text, href, target_title, lower(concat(coalesce(l.text, ''), ' ', href)) AS said,
  CASE WHEN {_LOWV.replace('text', 'l.text')} THEN 5 WHEN {any_sql("lower(concat(coalesce(l.text, ''), ' ', href))", fv.LINK_RANK_TERMS[0][1])} THEN 0
  WHEN {any_sql("lower(concat(coalesce(l.text, ''), ' ', href))", fv.LINK_RANK_TERMS[1][1])} THEN 1
  WHEN contains(lower(concat(coalesce(l.text, ''), ' ', href)), 'wiki') THEN 2 ELSE 3 END AS rk FROM links_t l JOIN base USING (n)),
lr1 AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY rk, said, pos) AS ix FROM lr0),
lr2 AS (SELECT *, trim(coalesce(nullif(text, ''), nullif(target_title, ''), concat('Source link ', ix))) AS lab FROM lr1 WHERE href <> '' AND NOT starts_with(href, '#')),
lr3 AS (SELECT *, CASE WHEN lower(lab) IN ('here', 'link', 'click here') THEN concat('Referenced source link ', ix) ELSE lab END AS label FROM lr2),
lre AS (SELECT * FROM lr3 WHERE rk <> 5 QUALIFY row_number() OVER (PARTITION BY document_id, href ORDER BY ix) = 1),
lra AS (SELECT * FROM lr3 QUALIFY row_number() OVER (PARTITION BY document_id, href ORDER BY ix) = 1)"""
FILES = """
ef AS (SELECT concat('out/', space_key, '/', page_id, '-a.md') AS path, n % 5 AS modified, page_id, 'k' AS kind FROM base
  UNION ALL SELECT concat('out/', space_key, '/', page_id, '-b.md'), n % 7, page_id, 'k' FROM base WHERE n % 6 = 0
  UNION ALL SELECT concat('out/', space_key, '/', n + 1000000, '-c.md'), 1, (n + 1000000)::VARCHAR, 's' FROM base WHERE n % 9 = 0
  UNION ALL SELECT concat('out/', space_key, '/readme', page_id, '.md'), 1, NULL, 'u' FROM base WHERE n % 11 = 0)"""
SCANNED = """sr AS (SELECT n, page_id, space_key, status, title, version FROM mf)"""

SQL = {
    "redact_secrets": with_corpus(
        f"SELECT document_id, sha256(t) AS clean_sha, {J('ws')} AS redaction_warnings FROM red", secrets_ctes()
    ),
    "failure_rows": with_corpus(
        "SELECT document_id, 'export' AS stage, 'ValueError' AS error_type, array_to_string(ws, ', ') AS message FROM redf WHERE len(ws) > 0", secrets_ctes()
    ),
    "warning_rows": with_corpus("SELECT document_id, unnest(ws) AS warning_type, 'export' AS stage FROM red", secrets_ctes()),
    "changed_only": _refresh_sql(""),
    "filter_document_type": _refresh_sql("AND document_type = '1-URGENT'"),
    "config_signature": f"""SELECT o_orderkey, sha256(concat('{{"o_custkey":', o_custkey, ',"o_orderstatus":"', o_orderstatus, '"}}')) AS sig,
        sha256('{{"prompt_version":"v1","scoring":{{"a":1}}}}') AS config FROM orders""",
    "select_pages": with_corpus("SELECT page_id, space_key FROM mf WHERE status = 'success' AND space_key = 'en' ORDER BY page_id LIMIT 40", MAN),
    "latest_run_per_command": f"""WITH {RUNS} SELECT * FROM rn WHERE command IN ('enrich', 'extract-visuals')
        QUALIFY row_number() OVER (PARTITION BY command ORDER BY run_id DESC) = 1""",
    "select_runs": f"WITH {RUNS} SELECT * FROM rn WHERE command IN ('enrich', 'extract-visuals')",
    "run_counts": f"""WITH {USE}, {FAIL}, p AS (SELECT concat('run-', lpad((user_id % 7)::VARCHAR, 2, '0')) AS run_id, count(*) FILTER (event_type = 'view') AS
        pages_processed, count(*) FILTER (event_type = 'click') AS pages_skipped FROM events WHERE event_type IN ('view', 'click') GROUP BY 1),
        f AS (SELECT run_id, count(*) AS failure_rows, count(DISTINCT page_id) AS pages_failed FROM fl GROUP BY 1),
        u AS (SELECT run_id, count(*) FILTER (NOT cached) AS live_calls, count(*) FILTER (cached) AS cached_calls,
        coalesce(sum(coalesce(input_tokens, 0) + output_tokens) FILTER (NOT cached), 0)::BIGINT AS live_tokens,
        coalesce(sum(coalesce(input_tokens, 0) + output_tokens) FILTER (cached), 0)::BIGINT AS cached_tokens FROM us GROUP BY 1)
        SELECT run_id, pages_processed, pages_skipped, failure_rows, pages_failed, live_calls, cached_calls, live_tokens, cached_tokens,
        CASE WHEN pages_failed = 0 THEN 'success' ELSE 'partial_success' END AS status FROM p JOIN f USING (run_id) JOIN u USING (run_id)""",
    "scan_run_history": f"""WITH {USE} SELECT DISTINCT run_id, CASE WHEN run_id < 'run-04' THEN 'enrich' ELSE 'report' END AS command FROM us WHERE run_id <> 'run-02'""",
    "scan_run_usage": f"WITH {USE} SELECT run_id, task, count(*) AS calls FROM us WHERE run_id IN ('run-00', 'run-01', 'run-03') GROUP BY ALL",
    "scan_run_failures": f"WITH {FAIL} SELECT run_id, page_id, stage, error_type FROM fl WHERE run_id IN ('run-00', 'run-03')",
    "write_enrichments": with_corpus(f"SELECT document_id, space_key, document_type, {J('review_flags')} AS review_flags FROM idx", index_sql()),
    "write_index_tables": with_corpus(
        f"SELECT document_id, 'r' AS run_id, document_type, {J('status_flags')} AS status_flags, word_count FROM idx", index_sql()
    ),
    "write_document_export": with_corpus(
        f"""SELECT space_key, document_id, concat('d/', space_key, '/', page_id, '-', coalesce(nullif(rtrim(substr(replace({NORM.format(c='title')}, ' ', '-'),
        1, 90), '-'), ''), 'untitled'), '.md') AS path, sha256(markdown) AS content FROM base"""
    ),
    "scan_manifest": with_corpus(
        """SELECT CASE WHEN c THEN NULL ELSE page_id END AS page_id, CASE WHEN c THEN NULL ELSE space_key END AS space_key,
        CASE WHEN c THEN NULL ELSE status END AS status, CASE WHEN c THEN NULL ELSE title END AS title, CASE WHEN c THEN NULL ELSE version END AS version, c AS corrupt
        FROM (SELECT *, n % 41 = 3 OR n % 43 = 2 AS c FROM mf)""", MAN,
    ),
    "scan_export_errors": "SELECT user_id::VARCHAR AS page_id, props AS error, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL",
    "scan_manifest_summary": "SELECT (SELECT count(*) FROM documents) AS total_pages, lang AS space_key, count(*) AS pages FROM documents GROUP BY lang",
    "scan_dataset": with_corpus("SELECT 'wiki' AS source, concat('corpus-', count(*)) AS dataset_name, max(updated_at) AS updated_at FROM base"),
    "scan_attachments": with_corpus(
        "SELECT concat('pages/', page_id) AS folder, array_to_string(list_sort(list(name)), '|') AS attachment_names FROM attachments_t GROUP BY page_id"
    ),
    "assemble_pages": with_corpus(
        "SELECT path AS folder, CASE WHEN n % 37 = 4 THEN concat(page_id, 'x') ELSE page_id END AS page_id, base.title, length(text) AS chars FROM mf JOIN base USING (n, page_id) "
        "WHERE mf.status = 'success' AND n % 47 <> 11 AND n % 31 <> 0", MAN,
    ),
    "page_id_mismatch": with_corpus("SELECT * FROM iss WHERE code = 'page_id_mismatch'", MAN, ISS),
    "validate_corpus": with_corpus("SELECT * FROM iss", MAN, ISS),
    "validation_summary": with_corpus(
        """SELECT (SELECT count(*) FROM mf) AS pages_total, (SELECT count(*) FROM ok WHERE page_id NOT IN (SELECT page_id FROM iss WHERE level = 'error')) AS
        pages_valid, (SELECT count(*) FROM ok WHERE page_id IN (SELECT page_id FROM iss WHERE level = 'error')) AS pages_failed,
        (SELECT count(*) FROM events WHERE event_type = 'error') AS export_errors, NOT EXISTS (SELECT 1 FROM iss WHERE level = 'error') AS ok""", MAN, ISS,
    ),
    "constraint_violations": with_corpus(
        """SELECT document_id, 'confidence' AS "column" FROM base WHERE n % 120 > 100 UNION ALL SELECT document_id, 'quality.overall_score' FROM base
        WHERE n % 130 > 100 UNION ALL SELECT document_id, 'document_type' FROM base WHERE n % 8 = 0"""
    ),
    "export_eligibility": with_corpus(
        """SELECT document_id, array_to_string(rs, '|') AS exclusion_reasons, len(rs) = 0 AS eligible FROM (SELECT document_id, list_filter([
        CASE WHEN audience = 'restricted_internal' THEN 'audience:restricted_internal' END, CASE WHEN sensitivity = 'restricted' THEN 'sensitivity:restricted' END,
        CASE WHEN content_availability = 'empty' THEN 'content_availability:empty' END, CASE WHEN list_contains(review_flags, 'future_dated') THEN
        'review_flag:future_dated' END, CASE WHEN list_contains(review_flags, 'visual_content_missing') THEN 'review_flag:visual_content_missing' END],
        lambda x: x IS NOT NULL) AS rs FROM idx)""", index_sql(),
    ),
    "low_value_links": with_corpus(
        f"SELECT document_id, {_LOWV.replace('text', 'l.text')} AS low_value, count(*) AS links FROM links_t l JOIN base USING (n) WHERE href <> '' GROUP BY ALL"
    ),
    "source_link_ranking": with_corpus(
        """SELECT document_id, 'early' AS section, row_number() OVER (PARTITION BY document_id ORDER BY ix) AS position, label, href FROM lre QUALIFY position <= 8
        UNION ALL SELECT document_id, 'additional', row_number() OVER (PARTITION BY document_id ORDER BY ix) AS position, label, href FROM lra""",
        LINKR,
    ),
    "export_metadata": with_corpus(
        """SELECT document_id, concat('#DOCUMENT_METADATA={"approval_status":"unreviewed","audience":"', audience, '","content_availability":"', content_availability,
        '","currentness":"current","dataset_name":"d","doc_updated_at":"', coalesce(source_updated_at, ''), CASE WHEN document_subtype IS NULL THEN '"' ELSE
        concat('","document_subtype":"', document_subtype, '"') END, ',"document_type":"', document_type, '","file_display_name":', to_json(title), ',"historical":',
        CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END, ',"link":"', url, '","quality_band":"good","review_flags":[', array_to_string(list_transform(review_flags,
        lambda f: concat('"', f, '"')), ','), '],"sensitivity":"', sensitivity, '","source_system":"wiki","space_key":"', space_key, '"}') AS metadata_line FROM idx""",
        index_sql(),
    ),
    "export_audit": with_corpus(
        """SELECT path, page_id, state, state IN ('stale', 'duplicate') AS to_remove FROM (SELECT path, ef.page_id, CASE WHEN kind = 'u' THEN 'unparseable'
        WHEN base.page_id IS NULL THEN 'stale' WHEN row_number() OVER (PARTITION BY ef.page_id ORDER BY modified DESC, path DESC) > 1 THEN 'duplicate'
        ELSE 'current' END AS state FROM ef LEFT JOIN base ON base.page_id = ef.page_id)""", FILES,
    ),
}
