"""Roll-ups, index rows and audit reports."""

from __future__ import annotations

from checks.corpus import (
    AS_OF, INDEX_NAMES, QUALITY_SQL, corpus_sql, documents, index_rows, index_sql, pages, quality_table, table,
    with_corpus,
)
from checks.q_classify import (
    ADJ, ATT_LINKS, COUNTS, FUTURE, HIER, J, SCORE_CTES, SCORES, WARN, adjusted, any_sql, classify_ctes, q,
    signals_cte, status_ctes,
)
from checks.q_extract import ENT, FACT, KW, KWDOC, NORM, _CO, _TH, entities, enriched_terms, facts, strings, taxonomy_ctes
from checks.q_profile import HEADINGS_SQL, TOKENS_SQL, simhash_sql
from corpuswright import fixed_values as fv
from corpuswright.operators import extract as ex
from corpuswright.operators import profile as pr
from corpuswright.operators import reports as rp
from corpuswright.operators import rollups as ro
from corpuswright.operators import score as sc
from pyspark.sql import functions as F


def part_entities(spark, sf):
    """Entities from parts: one row per (document, name)."""
    return table(spark, sf, "part").select(
        F.expr("concat('doc:', p_brand, ':', p_partkey % 500)").alias("document_id"),
        F.lit(1).alias("rank"),
        F.expr("element_at(array('queue', 'Support Team', 'link', 'database', 'Jira', 'thing', 'application'), p_size % 7 + 1)").alias("entity_type"),
        F.col("p_name").alias("name"),
        F.expr("lower(p_name)").alias("normalized_name"),
        F.expr("(p_size % 10) / 10.0D").alias("confidence"),
        F.lit("deterministic").alias("method"),
        F.expr("case when p_size % 3 = 0 then array(concat('aka ', p_brand), concat('aka ', p_type)) else cast(array() as array<string>) end").alias("aliases"),
        F.expr("array(named_struct('page_id', cast(p_partkey as string), 'evidence', concat(p_name, ' ', p_type), 'source_field', 'title'))").alias("mentions"),
    )


def part_docs(spark, sf):
    return part_entities(spark, sf).select("document_id").distinct().withColumns(
        {"space_key": F.split("document_id", ":")[1], "page_id": F.split("document_id", ":")[2]}
    )


def rolled(spark, sf):
    return ro.entity_rollup(part_entities(spark, sf), part_docs(spark, sf))


def _fact_rows(spark, sf):
    return ro.fact_rows(facts(spark, sf), documents(spark, sf))


def lines_facts(spark, sf):
    """Facts without their subjects (the reports only count them)."""
    return ex.candidate_facts(documents(spark, sf))


def _index_chain(spark, sf):
    df = adjusted(spark, sf)
    df = df.withColumns(
        {
            "review_flags": F.array().cast("array<string>"),
            "audience": F.lit("internal"),
            "sensitivity": F.lit("internal"),
        }
    )
    return ro.document_index_rows(df, pr.signatures(documents(spark, sf)))


def artifacts(spark, sf):
    """One image artifact per part, its images derived from the size."""
    t = table(spark, sf, "part").select("p_partkey", "p_size", "p_type", "p_name")
    image = (
        "named_struct('image_id', concat('image-', i), 'status', element_at(array('success','skipped','failed','success'), (p_size + i) % 4 + 1), "
        "'error_type', case (p_size + i) % 4 when 1 then 'remote_source_not_in_cache' when 2 then case when i % 2 = 0 then 'OSError' end end, "
        "'source_kind', case (p_size + i) % 4 when 1 then 'url' else 'file' end, "
        "'source', case (p_size + i) % 4 when 1 then concat('https://Img', p_size % 5, '.example.com:8080/', i, '.png') else concat(p_name, '/', i, '.png') end, "
        "'confidence', case when (p_size + i) % 4 in (0, 3) then ((p_partkey * 7 + i) % 100) / 100.0D end, "
        "'content_sha256', case when (p_size + i) % 4 <> 1 then sha2(concat(p_name, i % 3), 256) end)"
    )
    return t.select(
        F.expr("p_type").alias("space_key"),
        F.expr("cast(p_partkey as string)").alias("page_id"),
        F.expr(f"case when p_size % 6 = 0 then array() else transform(sequence(1, p_size % 6), i -> {image}) end").alias("images"),
        F.expr("element_at(array('complete', 'partial', 'skipped'), p_size % 3 + 1)").alias("status"),
        F.expr("p_size % 6").alias("image_count"),
        F.expr("p_size % 4").alias("images_succeeded"),
        F.expr("p_size % 2").alias("images_skipped"),
        F.expr("p_size % 3").alias("images_failed"),
        F.expr("p_size % 9 + 1").alias("discovered"),
    )


def usage(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "concat('run-', lpad(user_id % 7, 2, '0')) run_id", "cast(user_id as string) page_id",
        "event_type task", "element_at(array('a', 'b', 'c'), cast(event_id % 3 as int) + 1) provider",
        "element_at(array('m1', 'm2'), cast(event_id % 2 as int) + 1) model",
        "case when event_id % 9 = 0 then null else cast(floor(value * 100) as int) end input_tokens",
        "cast(floor(value * 10) as int) output_tokens", "event_id % 4 = 0 cached", "cast(event_id % 3 as int) retries",
    )


def rates(spark, sf):
    """Prices from suppliers: provider a has a price per model, b one without output, c none."""
    return table(spark, sf, "supplier").selectExpr(
        "case when s_suppkey < 3 then element_at(array('a:m1', 'm2', 'b'), cast(s_suppkey as int) + 1) else concat('other-', s_suppkey) end key",
        "round(s_acctbal / 100000, 6) input", "case when s_suppkey = 2 then null else round(s_acctbal / 50000, 6) end output",
        "s_suppkey",
    ).drop("s_suppkey")


def failures(spark, sf):
    return table(spark, sf, "events").where("event_type = 'error'").selectExpr(
        "concat('run-', lpad(user_id % 7, 2, '0')) run_id", "cast(user_id * 9 as string) page_id",
        "element_at(array('enrich', 'llm', 'export'), cast(event_id % 3 as int) + 1) stage",
        "concat('Error', event_id % 11) error_type", "event_id",
    )


def _task_failures(spark, sf):
    ctx = "named_struct('task', case when event_id % 2 = 0 then 'themes' end, 'provider', case when event_id % 3 = 0 then '' else 'p' end, 'model', cast(null as string), 'prompt_version', 'v1')"
    per_page = table(spark, sf, "events").where("event_type = 'error'").groupBy(F.col("user_id").alias("u")).agg(
        F.expr(
            f"collect_list(named_struct('stage', case when event_id % 5 = 0 then '' else 'llm' end, 'error_type', concat('E', event_id % 4), "
            f"'message', repeat(concat(event_id, ' '), 100), 'error_context', {ctx}))"
        ).alias("failures")
    )
    rows = per_page.selectExpr("'s' space_key", "cast(u as string) page_id", "concat('Page ', u) title", "failures")
    return rp.task_failures(rows)


def enriched_rule(spark, sf):
    """Enriched pages by rule for the section and owner reports."""
    df = index_rows(spark, sf).selectExpr(
        "*", "named_struct('has_owner', n % 4 = 0) signals", "named_struct('overall_score', cast(n * 13 % 101 as int)) quality",
        "case when n % 6 = 0 then null else concat('Section ', n % 40) end parent_title",
        "case when n % 12 = 0 then '' else concat('Root ', n % 7) end root_title",
    )
    return df


QUERIES = {
    "theme_rollup": lambda s, d: ro.theme_rollup(ex.themes(enriched_terms(s, d))),
    "theme_members": lambda s, d: ro.term_members(ex.themes(enriched_terms(s, d)), "themes").select("term", "document_id"),
    "concept_rollup": lambda s, d: ro.concept_rollup(ex.concepts(enriched_terms(s, d))),
    "entity_rollup": lambda s, d: rolled(s, d).select(
        "entity_id", "name", "normalized_name", "entity_type", "document_count", "confidence", "method",
        "mention_count", F.array_join("aliases", "|").alias("aliases"), "alias_count", F.element_at("mentions", 1)["document_id"].alias("first_document"),
    ),
    "entity_mentions": lambda s, d: ro.entity_mentions(part_entities(s, d)),
    "fact_rows": lambda s, d: _fact_rows(s, d).select("fact_id", "subject", "predicate", "object", "source_content_hash"),
    "fact_trust_split": lambda s, d: ro.fact_trust_split(lines_facts(s, d))[0].select("document_id", "predicate", "object", "confidence"),
    "evidence_hints": lambda s, d: ro.fact_trust_split(lines_facts(s, d))[1].select("document_id", "predicate", "object", "confidence"),
    "all_facts": lambda s, d: ro.all_facts(*ro.fact_trust_split(lines_facts(s, d))).select("document_id", "predicate", "object", "confidence"),
    "document_index_rows": lambda s, d: _index_chain(s, d).drop("review_flags", "audience", "sensitivity", "labels").withColumn(
        "document_type_confidence", F.round("document_type_confidence", 4)
    ),
    "quality_rows": lambda s, d: ro.quality_rows(sc.quality_warnings(adjusted(s, d))).select(
        "document_id", "quality_score", "quality_band", F.array_join("warnings", "|").alias("warnings"),
        *[F.col("dimensions")[k].alias(k) for k in ("freshness", "authority", "completeness", "contradiction_penalty")],
    ),
    "stable_order": lambda s, d: ro.stable_order(documents(s, d).select("space_key", "page_id")),
    "quality_lookup": lambda s, d: rp.quality_lookup(index_rows(s, d), quality_table(s, d)).select("document_id", "quality"),
    "stale_or_deprecated": lambda s, d: rp.stale_or_deprecated(index_rows(s, d), limit=None),
    "missing_owners": lambda s, d: rp.missing_owners(enriched_rule(s, d), limit=None),
    "corpus_summary": lambda s, d: rp.corpus_summary(index_rows(s, d), quality_table(s, d)),
    "document_types": lambda s, d: rp.document_types(index_rows(s, d)),
    "availability_counts": lambda s, d: rp.availability_counts(index_rows(s, d)),
    "subtree_value": lambda s, d: rp.subtree_value(enriched_rule(s, d)),
    "high_value_sources": lambda s, d: rp.high_value_sources(index_rows(s, d), quality_table(s, d)),
    "review_queue": lambda s, d: rp.review_queue(index_rows(s, d), quality_table(s, d)),
    "attachment_followups": lambda s, d: rp.attachment_followups(index_rows(s, d)),
    "export_risk": lambda s, d: rp.export_risk(index_rows(s, d), limit=None),
    "risk_flags_intersect": lambda s, d: index_rows(s, d).select(
        "document_id", F.array_sort(rp.risk_flags_intersect(F.col("review_flags"))).alias("risky")
    ),
    "risk_gate": lambda s, d: rp.risk_gate(index_rows(s, d), threshold=40),
    "entity_quality": lambda s, d: rp.entity_quality(rolled(s, d)),
    "noisy_union_low_confidence": lambda s, d: rp.noisy_union_low_confidence(rolled(s, d)),
    "fact_quality": lambda s, d: rp.fact_quality(lines_facts(s, d)),
    "usage_report": lambda s, d: rp.usage_report(rp.cost_rates(usage(s, d), rates(s, d))),
    "cost_rates": lambda s, d: rp.cost_rates(usage(s, d), rates(s, d)).groupBy("provider", "model").agg(
        F.count("estimated_cost_usd").alias("priced"), F.round(F.max("estimated_cost_usd"), 8).alias("dearest")
    ),
    "failure_summary": lambda s, d: rp.failure_summary(failures(s, d)),
    "task_failures": _task_failures,
    "failures_without_document": lambda s, d: rp.failures_without_document(failures(s, d), index_rows(s, d)),
    "visual_status_counts": lambda s, d: rp.visual_status_counts(artifacts(s, d)),
    "visual_remote_skips": lambda s, d: rp.visual_remote_skips(artifacts(s, d)),
    "visual_duplicates": lambda s, d: rp.visual_duplicates(artifacts(s, d)),
    "visual_coverage": lambda s, d: rp.visual_coverage(artifacts(s, d), documents(s, d)),
    "visual_capped": lambda s, d: rp.visual_capped(artifacts(s, d)),
    "visual_failed": lambda s, d: rp.visual_failed(artifacts(s, d)),
    "visual_low_confidence": lambda s, d: rp.visual_low_confidence(artifacts(s, d)),
    "visual_high_value_omitted": lambda s, d: rp.visual_high_value_omitted(artifacts(s, d), index_rows(s, d), quality_table(s, d)),
    "page_visual_status": lambda s, d: rp.page_visual_status(
        rp.visual_images(artifacts(s, d)).withColumn("document_id", F.concat_ws(":", "space_key", "page_id"))
    ),
    "write_report": lambda s, d: rp.markdown_rows(rp.document_types(index_rows(s, d))),
}

_KEEP1 = f"list_contains({strings(fv.SINGLE_WORDS_KEPT)}, term)"


def _roll(name: str, extra: str = "") -> str:
    return f"""SELECT concat('{name}:', rtrim(substr(replace(term, ' ', '-'), 1, 120), '-')) AS {name}_id, disp AS {name}, term AS normalized_{name},
        document_count, {0.65 if name == 'theme' else 0.58}::DOUBLE AS confidence, 'deterministic' AS method{extra} FROM (
        SELECT term, count(DISTINCT document_id) AS document_count, arg_min(v, (space_key, page_id, pos)) AS disp FROM
        (SELECT document_id, space_key, page_id, i AS pos, terms[i] AS v, {NORM.format(c='terms[i]')} AS term FROM tt JOIN base USING (document_id),
         unnest(range(1, len(terms) + 1)) u(i)) WHERE term <> '' GROUP BY term) WHERE contains(term, ' ') OR {_KEEP1} OR document_count >= 3"""


_PENT = """
pe AS (SELECT concat('doc:', p_brand, ':', p_partkey % 500) AS document_id, p_brand AS space_key, (p_partkey % 500)::VARCHAR AS page_id,
  (['queue', 'support_group', 'url', 'database', 'ticket', 'technology', 'application'])[p_size % 7 + 1] AS entity_type, p_name AS name,
  lower(p_name) AS normalized_name, (p_size % 10) / 10.0::DOUBLE AS confidence, concat(p_name, ' ', p_type) AS evidence, p_size, p_brand, p_type FROM part),
er AS (SELECT entity_type, normalized_name, count(DISTINCT document_id) AS document_count,
  round_even(sum((confidence * 10)::INT) * 10 / count(*), 0) / 100 AS confidence, arg_min(name, (space_key, page_id, name)) AS name,
  count(*) AS mention_count, min(document_id) AS first_document FROM pe GROUP BY ALL)"""
_TIER = """CASE WHEN entity_type IN ('url', 'contact', 'ticket') THEN 'contact_link_record'
  WHEN confidence >= 0.7 AND document_count >= 2 AND entity_type <> 'technology' THEN 'canonical_candidate' ELSE 'weak_signal' END"""

_PEN_T = NORM.format(c="title")
PEN = f"""
pn AS (SELECT idx.*, coalesce(quality_score, 0) AS quality, {_PEN_T} AS nt FROM idx LEFT JOIN (SELECT document_id, quality_score FROM qlt) USING (document_id)),
pq AS (SELECT *, (CASE WHEN document_type IN ('meeting_notes', 'project_plan', 'change_record') THEN 20 ELSE 0 END)
  + (CASE WHEN document_type IN ('archive', 'unknown') THEN 35 ELSE 0 END)
  + (CASE WHEN list_contains(status_flags, 'archived') THEN 30 ELSE 0 END) + (CASE WHEN list_contains(status_flags, 'stale') THEN 10 ELSE 0 END)
  + (CASE WHEN {any_sql('nt', ['handover', 'service review meeting'])} THEN 25 ELSE 0 END)
  + (CASE WHEN {any_sql('nt', ['release', 'rollback', 'report'])} THEN 15 ELSE 0 END)
  + (CASE WHEN {any_sql('nt', ['draft', 'rejected', 'template'])} THEN 25 ELSE 0 END)
  + (CASE WHEN list_contains(review_flags, 'future_dated') THEN 20 ELSE 0 END) AS pen,
  list_filter([CASE WHEN document_type IN ('runbook', 'support_model', 'architecture') THEN 'operational_source' END,
  CASE WHEN document_type IN ('meeting_notes', 'project_plan', 'change_record') THEN 'lower_authority_type' END,
  CASE WHEN list_contains(status_flags, 'stale') OR list_contains(status_flags, 'archived') THEN 'currentness_risk' END,
  CASE WHEN {any_sql('nt', ['handover', 'service review meeting', 'release', 'rollback'])} THEN 'dated_operational_record' END,
  CASE WHEN list_contains(review_flags, 'future_dated') THEN 'future_dated' END], lambda x: x IS NOT NULL) AS rs0 FROM pn),
pr AS (SELECT *, CASE WHEN len(rs0) = 0 THEN ['candidate_canonical_source'] ELSE rs0 END AS rs,
  list_contains(review_flags, 'manual_review_required') AS man, sensitivity NOT IN ('internal', 'public') AS sens,
  greatest(0, quality - pen + (CASE WHEN list_contains(review_flags, 'manual_review_required') THEN 30 ELSE 0 END)
  + (CASE WHEN document_type IN ('runbook', 'support_model', 'architecture') THEN 15 ELSE 0 END)
  + (CASE WHEN list_contains(review_flags, 'visual_content_missing') OR list_contains(review_flags, 'attachment_content_missing') THEN 10 ELSE 0 END)
  + (CASE WHEN sensitivity NOT IN ('internal', 'public') THEN 10 ELSE 0 END)) AS prio FROM pq)"""
_RISKY = f"list_sort(list_filter(review_flags, lambda f: list_contains({strings(fv.HIGH_RISK_FLAGS)}, f)))"
RISK = f"""rk AS (SELECT *, {_RISKY} AS risky, (CASE WHEN audience = 'restricted_internal' THEN 30 ELSE 0 END)
  + (CASE WHEN sensitivity NOT IN ('internal', 'public') THEN 30 ELSE 0 END) + 10 * len({_RISKY}) AS risk FROM idx)"""
ENR = """er0 AS (SELECT *, n % 4 = 0 AS has_owner, n * 13 % 101 AS score, CASE WHEN n % 6 = 0 THEN NULL ELSE concat('Section ', n % 40) END AS pt,
  CASE WHEN n % 12 = 0 THEN '' ELSE concat('Root ', n % 7) END AS rt FROM idx)"""
ART = """
ar AS (SELECT p_type AS space_key, p_partkey::VARCHAR AS page_id, p_partkey, p_size, p_name, p_size % 6 AS image_count,
  (['complete', 'partial', 'skipped'])[p_size % 3 + 1] AS status, p_size % 4 AS images_succeeded, p_size % 2 AS images_skipped, p_size % 3 AS images_failed,
  p_size % 9 + 1 AS discovered FROM part),
im AS (SELECT space_key, page_id, i AS pos, concat('image-', i) AS image_id, (['success','skipped','failed','success'])[(p_size + i) % 4 + 1] AS status,
  CASE (p_size + i) % 4 WHEN 1 THEN 'remote_source_not_in_cache' WHEN 2 THEN CASE WHEN i % 2 = 0 THEN 'OSError' END END AS error_type,
  CASE (p_size + i) % 4 WHEN 1 THEN 'url' ELSE 'file' END AS source_kind,
  CASE (p_size + i) % 4 WHEN 1 THEN concat('https://Img', p_size % 5, '.example.com:8080/', i, '.png') ELSE concat(p_name, '/', i, '.png') END AS source,
  CASE (p_size + i) % 4 WHEN 1 THEN concat('img', p_size % 5, '.example.com') END AS host,
  CASE WHEN (p_size + i) % 4 IN (0, 3) THEN ((p_partkey * 7 + i) % 100) / 100.0::DOUBLE END AS confidence,
  CASE WHEN (p_size + i) % 4 <> 1 THEN sha256(concat(p_name, i % 3)) END AS h FROM ar, unnest(range(1, image_count + 1)) u(i))"""
USE = """
us AS (SELECT concat('run-', lpad((user_id % 7)::VARCHAR, 2, '0')) AS run_id, user_id::VARCHAR AS page_id, event_type AS task,
  (['a', 'b', 'c'])[event_id % 3 + 1] AS provider, (['m1', 'm2'])[event_id % 2 + 1] AS model,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE floor(value * 100)::INT END AS input_tokens, floor(value * 10)::INT AS output_tokens,
  event_id % 4 = 0 AS cached, event_id % 3 AS retries FROM events),
rt AS (SELECT CASE WHEN s_suppkey < 3 THEN (['a:m1', 'm2', 'b'])[s_suppkey + 1] ELSE concat('other-', s_suppkey) END AS key, round(s_acctbal / 100000, 6) AS ri,
  CASE WHEN s_suppkey = 2 THEN NULL ELSE round(s_acctbal / 50000, 6) END AS ro FROM supplier),
uc AS (SELECT us.*, CASE WHEN a.key IS NOT NULL THEN a.ri WHEN b.key IS NOT NULL THEN b.ri ELSE c.ri END AS ri,
  CASE WHEN a.key IS NOT NULL THEN a.ro WHEN b.key IS NOT NULL THEN b.ro ELSE c.ro END AS ro FROM us
  LEFT JOIN rt a ON a.key = concat(provider, ':', model) LEFT JOIN rt b ON b.key = model LEFT JOIN rt c ON c.key = provider),
ud AS (SELECT *, round(coalesce(input_tokens, 0) / 1000 * ri + coalesce(output_tokens, 0) / 1000 * ro, 8) AS cost FROM uc)"""
FAIL = """fl AS (SELECT concat('run-', lpad((user_id % 7)::VARCHAR, 2, '0')) AS run_id, (user_id * 9)::VARCHAR AS page_id,
  (['enrich', 'llm', 'export'])[event_id % 3 + 1] AS stage, concat('Error', event_id % 11) AS error_type, event_id FROM events WHERE event_type = 'error')"""

SQL = {
    "theme_rollup": with_corpus(
        _roll("theme"), KW, classify_ctes("corpus"), KWDOC, taxonomy_ctes("kdoc", "document_id", _TH, "tt")
    ),
    "theme_members": with_corpus(
        f"""SELECT DISTINCT {NORM.format(c='terms[i]')} AS term, document_id FROM tt, unnest(range(1, len(terms) + 1)) u(i)""",
        KW, classify_ctes("corpus"), KWDOC, taxonomy_ctes("kdoc", "document_id", _TH, "tt"),
    ),
    "concept_rollup": with_corpus(
        _roll("concept", ", concat('Deterministic concept extracted from headings or keywords: ', disp) AS description"),
        KW, classify_ctes("corpus"), KWDOC, taxonomy_ctes("kdoc", "document_id", _CO, "tt"),
    ),
    "entity_mentions": f"""WITH {_PENT} SELECT entity_type, normalized_name, document_id, 'title' AS source_field, evidence FROM pe""",
    "entity_rollup": f"""WITH {_PENT}, al AS (SELECT entity_type, normalized_name, list_sort(list(DISTINCT a)) AS l FROM (SELECT entity_type, normalized_name,
        unnest(CASE WHEN p_size % 3 = 0 THEN [concat('aka ', p_brand), concat('aka ', p_type)] ELSE [] END) AS a FROM pe) GROUP BY ALL) SELECT concat('candidate:', entity_type, ':', replace(normalized_name, ' ', '-')) AS entity_id, name, normalized_name,
        entity_type, document_count, confidence, 'deterministic' AS method, mention_count, first_document,
        coalesce(array_to_string(l[1:100], '|'), '') AS aliases, coalesce(len(l), 0) AS alias_count FROM er LEFT JOIN al USING (entity_type, normalized_name)""",
    "fact_rows": with_corpus(
        """SELECT concat('fact:', space_key, ':', page_id, ':', ordinal) AS fact_id, subject, predicate, object, source_content_hash
        FROM fact JOIN corpus USING (document_id)""", KW, ENT, FACT,
    ),
    **{
        name: with_corpus(f"SELECT document_id, predicate, object, confidence FROM fact {where}", KW, ENT, FACT)
        for name, where in (("fact_trust_split", "WHERE confidence >= 0.7"), ("evidence_hints", "WHERE confidence < 0.7"), ("all_facts", ""))
    },
    "document_index_rows": with_corpus(
        f"""SELECT adj.document_id, adj.page_id, space_key, title, url, updated_at AS source_updated_at, source_content_hash, document_type,
        round(confidence, 4) AS document_type_confidence, document_subtype, content_availability, CASE WHEN tot2 >= 85 THEN 'excellent' WHEN tot2 >= 70
        THEN 'good' WHEN tot2 >= 50 THEN 'fair' ELSE 'poor' END AS quality_band, {J('flags')} AS status_flags, {J('ancestor_titles')} AS ancestor_titles,
        link_count AS outbound_link_count, coalesce(attachment_count, 0) AS attachment_count, toks AS word_count, heading_count,
        sig.simhash AS text_simhash, hsig.simhash AS heading_simhash, depth AS hierarchy_depth, parent_title, root_title, section_path, page_role,
        parent_context_type, sibling_count, child_count FROM adj LEFT JOIN lk USING (n) JOIN sig USING (document_id) JOIN hsig USING (document_id)""",
        *SCORE_CTES, ADJ, ATT_LINKS, simhash_sql("corpus", "document_id", "text", "sig"),
        f"heads AS (SELECT document_id, array_to_string({HEADINGS_SQL}, ' ') AS hd FROM base)", simhash_sql("heads", "document_id", "hd", "hsig"),
    ),
    "quality_rows": with_corpus(
        f"""SELECT document_id, tot2 AS quality_score, CASE WHEN tot2 >= 85 THEN 'excellent' WHEN tot2 >= 70 THEN 'good' WHEN tot2 >= 50 THEN 'fair'
        ELSE 'poor' END AS quality_band, {J('warnings')} AS warnings, fr AS freshness, au1 AS authority, co2 AS completeness, cr AS contradiction_penalty
        FROM warn""", *SCORE_CTES, ADJ, ATT_LINKS, WARN,
    ),
    "stable_order": with_corpus("SELECT space_key, page_id FROM base ORDER BY space_key, page_id"),
    "quality_lookup": with_corpus(
        "SELECT document_id, coalesce(quality_score, 0) AS quality FROM idx LEFT JOIN (SELECT document_id, quality_score FROM qlt) USING (document_id)",
        index_sql(), QUALITY_SQL,
    ),
    "stale_or_deprecated": with_corpus(
        f"""SELECT space_key, page_id, title, {J('status_flags')} AS status_flags, url FROM idx WHERE list_contains(status_flags, 'stale')
        OR list_contains(status_flags, 'archived') OR list_contains(status_flags, 'deprecated')""", index_sql(),
    ),
    "missing_owners": with_corpus(
        "SELECT space_key, page_id, document_type, title FROM er0 WHERE NOT has_owner AND score >= 50", index_sql(), ENR
    ),
    "corpus_summary": with_corpus(
        """SELECT (SELECT count(*) FROM idx) AS documents, (SELECT count(*) FROM idx WHERE n % 11 = 0 OR n % 7 = 0) AS stale_documents,
        (SELECT round_even(avg(quality_score), 0)::BIGINT FROM qlt) AS average_quality, (SELECT count(*) FROM qlt WHERE quality_score >= 70) AS good_documents""",
        index_sql(), QUALITY_SQL,
    ),
    "document_types": with_corpus("SELECT document_type, count(*) AS documents FROM idx GROUP BY 1", index_sql()),
    "availability_counts": with_corpus("SELECT content_availability, count(*) AS documents FROM idx GROUP BY 1", index_sql()),
    "subtree_value": with_corpus(
        """SELECT section, pages, average_quality, operational_pages, roles FROM (SELECT coalesce(nullif(pt, ''), nullif(rt, ''), 'unknown') AS section,
        count(*) AS pages, round_even(avg(score), 0)::BIGINT AS average_quality, count(*) FILTER (document_type IN ('runbook', 'support_model', 'architecture'))
        AS operational_pages, array_to_string((list_sort(list(DISTINCT page_role)))[1:8], ', ') AS roles, min((space_key, page_id)) AS f
        FROM er0 GROUP BY 1) ORDER BY average_quality DESC, pages DESC, f LIMIT 100""", index_sql(), ENR,
    ),
    "high_value_sources": with_corpus(
        """SELECT space_key, page_id, quality, quality - pen AS priority, document_type, array_to_string(rs, ', ') AS reason, title, url FROM pr
        ORDER BY quality - pen DESC, outbound_link_count DESC, word_count DESC, space_key, page_id LIMIT 100""", index_sql(), QUALITY_SQL, PEN,
    ),
    "review_queue": with_corpus(
        """SELECT prio AS priority, space_key, page_id, document_type, coalesce(document_subtype, '') AS document_subtype, quality,
        array_to_string(list_concat(rs, list_filter([CASE WHEN man THEN 'manual_review_required' END, CASE WHEN sens THEN 'sensitive_content' END,
        CASE WHEN list_contains(review_flags, 'visual_content_missing') THEN 'visual_content_missing' END,
        CASE WHEN list_contains(review_flags, 'attachment_content_missing') THEN 'attachment_content_missing' END], lambda x: x IS NOT NULL)), ', ') AS reasons,
        title, url FROM pr WHERE prio >= 40 OR man ORDER BY prio DESC, space_key, page_id LIMIT 200""", index_sql(), QUALITY_SQL, PEN,
    ),
    "attachment_followups": with_corpus(
        """SELECT space_key, page_id, attachment_count, title, url FROM idx WHERE attachment_count > 0 ORDER BY attachment_count DESC, space_key, page_id
        LIMIT 200""", index_sql(),
    ),
    "export_risk": with_corpus(
        """SELECT space_key, page_id, risk, audience, sensitivity, array_to_string(list_concat(list_filter([CASE WHEN audience = 'restricted_internal'
        THEN 'restricted_audience' END, CASE WHEN sensitivity NOT IN ('internal', 'public') THEN sensitivity END], lambda x: x IS NOT NULL), risky), ', ')
        AS reasons, title, url FROM rk WHERE risk > 0""", index_sql(), RISK,
    ),
    "risk_flags_intersect": with_corpus(f"SELECT document_id, {J('risky')} AS risky FROM rk", index_sql(), RISK),
    "risk_gate": with_corpus(
        """SELECT 'warn' AS action, 40 AS threshold, count(*) FILTER (risk >= 40) AS risky_pages, concat('Risk gate: warn at threshold 40; ',
        count(*) FILTER (risk >= 40), ' page(s) meet or exceed the threshold.') AS note FROM rk""", index_sql(), RISK,
    ),
    "entity_quality": f"""WITH {_PENT}, et AS (SELECT *, {_TIER} AS tier FROM er)
        SELECT 'total' AS measure, 'entities' AS key, count(*) AS entities FROM et HAVING count(*) > 0
        UNION ALL SELECT 'type', entity_type, count(*) FROM et GROUP BY 2 UNION ALL SELECT 'tier', tier, count(*) FROM et GROUP BY 2
        UNION ALL SELECT 'total', 'links_contacts_tickets', count(*) FROM et WHERE entity_type IN ('url', 'contact', 'ticket') HAVING count(*) > 0
        UNION ALL SELECT 'total', 'low_confidence', count(*) FROM et WHERE confidence < 0.5 HAVING count(*) > 0""",
    "noisy_union_low_confidence": f"""WITH {_PENT}, et AS (SELECT *, {_TIER} AS tier FROM er), nu AS (
        SELECT tier, entity_type, name, document_count, confidence FROM et WHERE entity_type IN ('url', 'contact', 'ticket')
        UNION ALL SELECT tier, entity_type, name, document_count, confidence FROM et WHERE confidence < 0.5)
        SELECT * FROM nu ORDER BY entity_type, name""",
    "fact_quality": with_corpus(
        """SELECT 'total' AS measure, 'facts' AS key, count(*) AS facts FROM fact UNION ALL SELECT 'total', CASE WHEN confidence >= 0.7 THEN 'usable' ELSE
        'hints' END, count(*) FROM fact GROUP BY 2 UNION ALL SELECT 'claim_type', claim_type, count(*) FROM fact GROUP BY 2
        UNION ALL SELECT 'predicate', predicate, count(*) FROM fact GROUP BY 2""", KW, ENT, FACT,
    ),
    "usage_report": f"""WITH {USE} SELECT provider, model, task, count(*) AS calls, count(*) FILTER (NOT cached) AS live_calls,
        sum(coalesce(input_tokens, 0))::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens,
        coalesce(sum(coalesce(input_tokens, 0)) FILTER (NOT cached), 0)::BIGINT AS live_input_tokens,
        coalesce(sum(output_tokens) FILTER (NOT cached), 0)::BIGINT AS live_output_tokens, count(*) FILTER (cached) AS cached,
        round(count(*) FILTER (cached) / count(*), 4) AS hit_rate, sum(retries)::BIGINT AS retries, round(coalesce(sum(cost::DECIMAL(28,8)), 0), 6)::DOUBLE AS cost_usd,
        CASE WHEN count(cost) > 0 THEN 'configured' ELSE 'not configured' END AS cost_status FROM ud GROUP BY ALL""",
    "cost_rates": f"WITH {USE} SELECT provider, model, count(cost) AS priced, round(max(cost), 8) AS dearest FROM ud GROUP BY ALL",
    "failure_summary": f"""WITH {FAIL} SELECT stage, error_type, count(*) AS failures FROM fl GROUP BY ALL
        ORDER BY failures DESC, stage, error_type""",
    "task_failures": """SELECT 's' AS space_key, user_id::VARCHAR AS page_id, concat('Page ', user_id) AS title,
        CASE WHEN event_id % 2 = 0 THEN 'themes' WHEN event_id % 5 = 0 THEN 'unknown' ELSE 'llm' END AS task,
        CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE 'p' END AS provider, 'unknown' AS model, 'v1' AS prompt_version,
        concat('E', event_id % 4) AS error_type, repeat(concat(event_id, ' '), 100) AS message,
        'deterministic_fallback_retained' AS fallback FROM events WHERE event_type = 'error'""",
    "failures_without_document": with_corpus(
        "SELECT * FROM fl WHERE page_id NOT IN (SELECT page_id FROM idx)", index_sql(), FAIL
    ),
    "visual_status_counts": f"""WITH {ART}, s0 AS (SELECT 'page' AS scope, status, count(*) AS n FROM ar GROUP BY ALL
        UNION ALL SELECT 'image', status, count(*) FROM im GROUP BY ALL
        UNION ALL SELECT 'image', 'success', sum(images_succeeded) FROM ar WHERE image_count = 0
        UNION ALL SELECT 'image', 'skipped', sum(images_skipped) FROM ar WHERE image_count = 0
        UNION ALL SELECT 'image', 'failed', sum(images_failed) FROM ar WHERE image_count = 0
        UNION ALL SELECT 'page', unnest(['complete', 'partial', 'skipped', 'failed']), 0)
        SELECT scope, status, sum(n)::BIGINT AS n FROM s0 GROUP BY ALL""",
    "visual_remote_skips": f"""WITH {ART} SELECT host, source_kind, error_type, count(*) AS images FROM im
        WHERE status = 'skipped' AND error_type = 'remote_source_not_in_cache' GROUP BY ALL""",
    "visual_duplicates": f"""WITH {ART} SELECT h AS content_sha256, count(*) AS images,
        array_to_string((list(concat(space_key, ':', page_id, ':', image_id) ORDER BY space_key, page_id, pos))[1:12], ', ') AS samples,
        array_to_string((list(source ORDER BY space_key, page_id, pos))[1:4], ', ') AS sources FROM im WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1""",
    "visual_coverage": with_corpus(
        """SELECT (SELECT count(*) FROM base) AS pages, (SELECT count(*) FROM ar) AS pages_with_artifacts, (SELECT sum(discovered) FROM ar)::BIGINT AS images_discovered,
        (SELECT sum(CASE WHEN image_count > 0 THEN image_count ELSE images_succeeded + images_skipped + images_failed END) FROM ar)::BIGINT AS images_in_artifacts,
        greatest((SELECT count(*) FROM base) - (SELECT count(*) FROM ar), 0) AS pages_without_artifacts""", ART,
    ),
    "visual_capped": f"""WITH {ART} SELECT space_key, page_id, discovered, image_count AS processed, discovered - image_count AS omitted FROM ar
        WHERE discovered > image_count ORDER BY omitted DESC, space_key, page_id""",
    "visual_failed": f"""WITH {ART} SELECT space_key, page_id, image_id, coalesce(error_type, 'unknown') AS error_type, source_kind, source FROM im
        WHERE status = 'failed' ORDER BY space_key, page_id, image_id""",
    "visual_low_confidence": f"""WITH {ART} SELECT confidence, space_key, page_id, image_id, source_kind, source FROM im
        WHERE status = 'success' AND confidence < 0.75 ORDER BY confidence, space_key, page_id, pos""",
    "visual_high_value_omitted": with_corpus(
        """SELECT prio AS priority, ar.space_key, page_id, document_type, coalesce(document_subtype, '') AS document_subtype, quality, discovered,
        image_count AS processed, discovered - image_count AS omitted, title, url FROM ar JOIN pr USING (page_id) WHERE discovered > image_count
        AND (prio >= 80 OR document_type IN ('runbook', 'support_model')) ORDER BY prio DESC, omitted DESC, ar.space_key, page_id""",
        index_sql(), QUALITY_SQL, PEN, ART,
    ),
    "page_visual_status": f"""WITH {ART}, ps AS (SELECT concat(space_key, ':', page_id) AS document_id, count(*) AS image_count, count(*) FILTER (status = 'success')
        AS images_succeeded, count(*) FILTER (status = 'failed') AS images_failed, count(*) FILTER (status = 'skipped') AS images_skipped FROM im GROUP BY ALL)
        SELECT *, CASE WHEN images_succeeded = image_count THEN 'complete' WHEN images_succeeded > 0 THEN 'partial' WHEN images_skipped = image_count
        THEN 'skipped' ELSE 'failed' END AS status FROM ps""",
    "write_report": with_corpus(
        "SELECT concat('| ', document_type, ' | ', count(*), ' |') AS value FROM idx GROUP BY document_type", index_sql()
    ),
}
