"""Hierarchy, classification, signals, scores, flags."""

from __future__ import annotations

from checks.corpus import AS_OF, documents, pages, table, with_corpus
from checks.q_profile import BODY_SQL, HEADINGS_SQL, TOKENS_SQL, WORDS_SQL
from corpuswright import fixed_values as fv
from corpuswright.functions.times import age_days, instant, parse_timestamp
from corpuswright.operators import classify as cl
from corpuswright.operators import flags as fl
from corpuswright.operators import hierarchy as hi
from corpuswright.operators import profile as pr
from corpuswright.operators import score as sc
from corpuswright.plans.enrich import HEAVY
from pyspark.sql import functions as F

INSIDE = ["corp.example"]
PERSON_ID = r"\bEMP-[A-Z0-9]{4,}\b"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_sql(c: str, terms) -> str:
    return "(" + " OR ".join(f"contains({c}, {q(t)})" for t in terms) + ")"


# ---- Spark side -------------------------------------------------------------------------------


def classified(spark, sf):
    return cl.document_subtypes(cl.classify_documents(pages(spark, sf)))


def flagged(spark, sf):
    return cl.status_flags(classified(spark, sf), AS_OF)


def profiled(spark, sf, with_attachments=False):
    base = pages(spark, sf, with_attachments=with_attachments)
    return pr.content_availability(pr.text_stats(fl.attachment_gap(base)))


def scored(spark, sf, with_attachments=False):
    df = cl.document_subtypes(cl.classify_documents(profiled(spark, sf, with_attachments)))
    df = cl.operational_signals(cl.status_flags(df, AS_OF))
    return sc.procedure_features(sc.quality_scores(df, AS_OF))


def adjusted(spark, sf, with_attachments=False):
    slim = scored(spark, sf, with_attachments).drop(*HEAVY)
    counts = hi.hierarchy_counts(documents(spark, sf))
    return sc.quality_adjust(hi.hierarchy_context(slim, counts))


def _unpack(df, column, names):
    return df.select("document_id", *[F.col(f"{column}.{n}").alias(n) for n in names])


QUALITY = [
    "freshness_score", "authority_score", "completeness_score", "operational_value_score",
    "ownership_clarity_score", "staleness_risk_score", "contradiction_risk_score", "overall_score",
]


def _all_flags(spark, sf):
    df = cl.document_subtypes(cl.classify_documents(profiled(spark, sf, True)))
    df = fl.trust_flags(fl.sensitivity_flags(df, inside_domains=INSIDE, person_id=PERSON_ID), AS_OF)
    # an earlier extraction exists for some pages
    n = F.col("n")
    df = df.withColumns(
        {
            "visual_status": F.when(n % 12 == 1, "complete").when(n % 12 == 5, "partial"),
            "images_succeeded": F.when(n % 12 == 5, 2).when(n % 12 == 1, 5),
        }
    )
    return fl.review_flags_union(fl.usability_flags(fl.missing_content_flags(df)))


QUERIES = {
    "hierarchy_counts": lambda s, d: hi.hierarchy_counts(documents(s, d)),
    "hierarchy_context": lambda s, d: hi.hierarchy_context(
        documents(s, d), hi.hierarchy_counts(documents(s, d))
    ).select(
        "document_id", "depth", "root_title", "parent_title", "section_path", "parent_context_type",
        "ancestor_context_types", "page_role", "is_root_page", "is_index_page", "is_leaf_page",
    ),
    "classify_documents": lambda s, d: cl.classify_documents(documents(s, d)).select(
        "document_id", "document_type", F.round("document_type_confidence", 4).alias("confidence")
    ),
    "document_subtypes": lambda s, d: classified(s, d).select(
        "document_id", "document_type", "document_subtype"
    ),
    "status_flags": lambda s, d: flagged(s, d).select(
        "document_id", "status_flags", "historical", "currentness"
    ),
    "operational_signals": lambda s, d: _unpack(
        cl.operational_signals(pages(s, d)), "signals", fv.SIGNAL_TERMS
    ),
    "parse_timestamps": lambda s, d: documents(s, d).select(
        "document_id",
        F.unix_seconds(parse_timestamp(F.col("updated_at"))).alias("seconds"),
        age_days(F.col("updated_at"), instant(AS_OF)).alias("age_days"),
    ),
    "quality_scores": lambda s, d: _unpack(scored(s, d), "quality", QUALITY),
    "quality_adjust": lambda s, d: adjusted(s, d).select(
        "document_id", "quality.completeness_score", "quality.authority_score",
        "quality.operational_value_score", "quality.ownership_clarity_score", "quality.overall_score",
        "quality_band", F.round(sc.page_confidence(), 6).alias("confidence"),
    ),
    "quality_warnings": lambda s, d: sc.quality_warnings(adjusted(s, d)).select("document_id", "warnings"),
    "sensitivity_flags": lambda s, d: fl.sensitivity_flags(pages(s, d), inside_domains=INSIDE, person_id=PERSON_ID).select(
        "document_id", "sensitivity_flags", fl.audience(F.col("sensitivity_flags")).alias("audience"),
        fl.sensitivity(F.col("sensitivity_flags")).alias("sensitivity"),
    ),
    "future_dates": lambda s, d: fl.future_dates(documents(s, d), AS_OF).select(
        "document_id", "has_future_date"
    ),
    "trust_flags": lambda s, d: fl.trust_flags(classified(s, d), AS_OF).select("document_id", "trust_flags"),
    "missing_content_flags": lambda s, d: _all_flags(s, d).select("document_id", "missing_content_flags"),
    "usability_flags": lambda s, d: fl.usability_flags(documents(s, d)).select("document_id", "usability_flags"),
    "review_flags_union": lambda s, d: _all_flags(s, d).select(
        "document_id", "review_flags", "audience", "sensitivity"
    ),
    "attachment_gap": lambda s, d: fl.attachment_gap(pages(s, d, with_attachments=True)).select(
        "document_id", "missing_attachment_names", "referenced_attachment_names", "attachment_count"
    ),
}


# ---- SQL side ---------------------------------------------------------------------------------


def context_sql(c: str) -> str:
    whens = " ".join(f"WHEN {any_sql(f'lower({c})', terms)} THEN {q(n)}" for n, terms in fv.CONTEXT_TERMS.items())
    return f"(CASE WHEN {c} IS NULL OR {c} = '' THEN NULL {whens} END)"


COUNTS = """
par AS (SELECT document_id, page_id, CASE WHEN len(ancestor_ids) > 0 THEN ancestor_ids[-1] ELSE '__root__' END AS parent
        FROM corpus),
counts AS (SELECT p.document_id, (SELECT count(*) FROM par c WHERE c.parent = p.page_id) AS child_count,
        (SELECT count(*) - 1 FROM par s WHERE s.parent = p.parent) AS sibling_count FROM par p)"""

_CTX = f"list_filter(list_transform(ancestor_titles, lambda t: {context_sql('t')}), lambda x: x IS NOT NULL)"
HIER = f"""
h0 AS (SELECT corpus.*, child_count, sibling_count, len(ancestor_titles) AS depth,
        CASE WHEN len(ancestor_titles) > 0 THEN ancestor_titles[-1] END AS parent_title,
        CASE WHEN len(ancestor_titles) > 0 THEN ancestor_titles[1] ELSE title END AS root_title,
        array_to_string(list_filter(list_append(ancestor_titles, title), lambda t: t <> ''), ' > ') AS section_path,
        list_sort(list_distinct({_CTX})) AS ctx
        FROM corpus JOIN counts USING (document_id)),
h1 AS (SELECT *, {context_sql('parent_title')} AS parent_context_type, {context_sql('title')} AS own FROM h0),
hier AS (SELECT *, CASE
        WHEN child_count > 0 AND {any_sql('lower(title)', ['index', 'summary', 'overview'])} THEN 'index_page'
        WHEN child_count > 0 AND own = 'runbook' THEN 'runbook_index'
        WHEN {any_sql('lower(title)', ['rollback', 'failover', 'procedure'])} THEN 'procedure_page'
        WHEN {any_sql('lower(title)', ['release', 'change'])} THEN 'release_note'
        WHEN {any_sql('lower(title)', fv.CONTEXT_TERMS['performance'])} THEN 'test_report'
        WHEN parent_context_type = 'runbook' OR list_contains(ctx, 'runbook') THEN 'runbook_detail'
        WHEN parent_context_type IN ('architecture', 'business', 'reference') THEN 'reference_detail'
        WHEN child_count > 0 THEN 'index_page' ELSE 'leaf_page' END AS page_role FROM h1)"""


def _override_sql() -> str:
    parts = []
    for where, terms, mode, name, conf in fv.TITLE_OVERRIDES:
        c = {"title": "lt", "path": "lp", "pattern": "lt"}[where]
        if where == "pattern":
            cond = f"regexp_matches(lt, {q(terms[0])})"
        else:
            cond = "(" + (" AND " if mode == "all" else " OR ").join(f"contains({c}, {q(t)})" for t in terms) + ")"
        parts.append((cond, name, conf))
    return parts


def classify_ctes(source: str) -> str:
    over = _override_sql()
    names = list(fv.DOCUMENT_TYPE_TERMS)
    pts = [
        " + ".join(
            f"(CASE WHEN contains(lt, {q(t)}) THEN 2 WHEN contains(lh, {q(t)}) THEN 1 ELSE 0 END)" for t in terms
        )
        for terms in fv.DOCUMENT_TYPE_TERMS.values()
    ]
    coded = ", ".join(f"({p}) * 100 + {99 - i}" for i, p in enumerate(pts))
    types = "[" + ", ".join(q(n) for n in names) + "]"
    otype = "CASE " + " ".join(f"WHEN {c} THEN {q(n)}" for c, n, _ in over) + " END"
    oconf = "CASE " + " ".join(f"WHEN {c} THEN {conf}::DOUBLE" for c, _, conf in over) + " END"
    sub = " ".join(f"WHEN {any_sql('lp', t)} THEN {q(n)}" for n, t in fv.SUBTYPE_TERMS.items())
    strong = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in fv.SUBTYPE_TYPE.items())
    weak = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in fv.SUBTYPE_TYPE_IF_UNKNOWN.items())
    return f"""
c0 AS (SELECT {source}.*, lower(title) AS lt,
        lower(concat(title, chr(10), array_to_string(ancestor_titles, ' '))) AS lp,
        lower(concat(title, ' ', array_to_string(labels, ' '), ' ', array_to_string(ancestor_titles, ' '), ' ',
              text)) AS lh FROM {source}),
c1 AS (SELECT *, {otype} AS otype, {oconf} AS oconf, greatest({coded}) AS code,
        {TOKENS_SQL.format(c='text')} AS toks FROM c0),
c2 AS (SELECT * EXCLUDE (lh), CASE WHEN otype IS NOT NULL THEN otype WHEN code >= 100 THEN {types}[100 - (code % 100)]
        WHEN toks < 80 THEN 'reference' ELSE 'unknown' END AS dtype,
        CASE WHEN otype IS NOT NULL THEN oconf WHEN code >= 100 THEN least(0.95::DOUBLE, 0.55::DOUBLE + (code // 100) * 0.08::DOUBLE)
        WHEN toks < 80 THEN 0.45 ELSE 0.35 END AS confidence FROM c1),
c3 AS (SELECT *, CASE {sub} WHEN dtype IN ('support_model', 'rca', 'incident') THEN dtype END AS document_subtype FROM c2),
cls AS (SELECT *, coalesce(CASE document_subtype {strong} END,
        CASE WHEN dtype = 'unknown' THEN CASE document_subtype {weak} END END, dtype) AS document_type FROM c3)"""


TS = (
    "CASE WHEN updated_at LIKE '20%' THEN (CASE WHEN updated_at LIKE '%Z' OR updated_at LIKE '%+02:00' THEN updated_at "
    "ELSE updated_at || 'Z' END)::TIMESTAMPTZ END"
)
AGE = f"floor((epoch_us('{AS_OF}'::TIMESTAMPTZ) - epoch_us({TS})) / 86400000000.0)::BIGINT"
_SAID = "lower(concat(title, ' ', array_to_string(labels, ' '), ' ', coalesce(status, '')))"


def status_ctes(source: str = "cls") -> str:
    state = (
        "CASE WHEN list_contains(f0, 'archived') OR list_contains(f0, 'deprecated') THEN 'deprecated' "
        "WHEN document_type = 'rca' THEN 'historical' WHEN age IS NULL THEN 'unknown' WHEN age > 730 THEN 'stale' ELSE 'current' END"
    )
    return f"""
s0 AS (SELECT *, {AGE} AS age, list_filter([status, CASE WHEN document_type = 'archive' OR contains({_SAID}, 'archive')
        THEN 'archived' END, CASE WHEN {any_sql(_SAID, ['deprecated', 'obsolete', 'retired'])} THEN 'deprecated' END],
        lambda x: x IS NOT NULL) AS f0 FROM {source}),
s1 AS (SELECT *, {state} AS st FROM s0),
s2 AS (SELECT *, list_sort(list_distinct(list_concat(f0, CASE WHEN st IN ('deprecated', 'historical') THEN ['historical', st]
        ELSE [st] END))) AS flags FROM s1),
sta AS (SELECT *, list_contains(flags, 'archived') OR list_contains(flags, 'deprecated') OR document_type = 'rca' AS historical,
        CASE WHEN list_contains(flags, 'archived') OR list_contains(flags, 'deprecated') THEN 'deprecated'
        WHEN document_type = 'rca' THEN 'historical' WHEN age IS NULL THEN 'unknown' WHEN age > 730 THEN 'stale'
        ELSE 'current' END AS currentness FROM s2)"""


_HAY = "lower(concat(title, ' ', text, ' ', hrefs))"


def signals_cte(source: str) -> str:
    cols = ", ".join(f"{any_sql('hay', t)} AS {n}" for n, t in fv.SIGNAL_TERMS.items())
    return f"sig0 AS (SELECT *, {_HAY} AS hay FROM {source}), sgn AS (SELECT *, {cols} FROM sig0)"


NSIG = "(" + " + ".join(f"{n}::INT" for n in fv.SIGNAL_TERMS) + ")"
_AUTH = "CASE document_type " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in fv.AUTHORITY.items()) + " ELSE 10 END"
_OPER = "CASE document_type " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in fv.OPERATIONAL_BASE.items()) + " ELSE 35 END"
SCORES = f"""
q0 AS (SELECT *, {WORDS_SQL.format(c='text')} AS score_words, len({HEADINGS_SQL}) AS heading_count, {NSIG} AS nsig,
        CASE WHEN contains(lower({BODY_SQL}), 'no exportable body content') THEN 'empty'
        WHEN {WORDS_SQL.format(c='text')} < 80 THEN 'thin' ELSE 'normal' END AS content_availability FROM sgn),
q1 AS (SELECT *, CASE WHEN document_type = 'rca' THEN 75 WHEN list_contains(flags, 'archived') OR list_contains(flags, 'deprecated')
        THEN 15 WHEN age IS NULL THEN 35 WHEN age <= 90 THEN 100 WHEN age <= 180 THEN 85 WHEN age <= 365 THEN 70
        WHEN age <= 730 THEN 45 ELSE 20 END AS fr,
        greatest(0, greatest(0, {_AUTH} - CASE WHEN list_contains(flags, 'deprecated') THEN 50 ELSE 0 END)
          - CASE WHEN list_contains(flags, 'archived') THEN 40 ELSE 0 END) AS au,
        least(100, 20 + (CASE WHEN score_words >= 200 THEN 20 ELSE 0 END) + (CASE WHEN score_words >= 800 THEN 15 ELSE 0 END)
          + (CASE WHEN heading_count >= 3 THEN 15 ELSE 0 END) + (CASE WHEN heading_count >= 8 THEN 10 ELSE 0 END)
          + least(20, 3 * nsig)) AS co,
        least(100, {_OPER} + least(20, 2 * nsig) + least(5, link_count)) AS op,
        45 * has_owner::INT + 35 * has_support_group::INT + 20 * has_escalation_path::INT AS ow,
        CASE WHEN document_type IN ('unknown', 'meeting_notes', 'project_plan') THEN 35 ELSE 10 END AS cr FROM q0),
qual AS (SELECT *, greatest(0, least(100, round_even(fr * 0.2::DOUBLE + au * 0.2::DOUBLE + co * 0.2::DOUBLE + op * 0.25::DOUBLE
        + ow * 0.1::DOUBLE - cr * 0.05::DOUBLE, 0)))::BIGINT AS total FROM q1)"""
ADJ = """
a0 AS (SELECT *, (CASE WHEN parent_context_type IN ('runbook', 'support_model', 'architecture') THEN 5 ELSE 0 END)
        + (CASE WHEN page_role IN ('runbook_detail', 'procedure_page') THEN 5 ELSE 0 END) AS bonus FROM qual),
a1 AS (SELECT *, CASE WHEN page_role IN ('index_page', 'runbook_index') AND co < 50 THEN greatest(0, co - 5) ELSE co END AS co1,
        least(100, au + bonus) AS au1, least(100, op + bonus) AS op1, least(100, total + bonus * 2 // 5) AS tot1 FROM a0),
adj AS (SELECT *, CASE content_availability WHEN 'empty' THEN least(co1, 10) WHEN 'thin' THEN least(co1, 35) ELSE co1 END AS co2,
        CASE content_availability WHEN 'empty' THEN least(op1, 20) ELSE op1 END AS op2,
        CASE content_availability WHEN 'empty' THEN least(ow, 10) ELSE ow END AS ow2,
        CASE content_availability WHEN 'empty' THEN least(tot1, 25) WHEN 'thin' THEN least(tot1, 55) ELSE tot1 END AS tot2 FROM a1)"""
ATT = """
att_own AS (SELECT page_id, list_sort(list(name)) AS names FROM attachments_t GROUP BY page_id),
att_link AS (SELECT n, list_sort(list_distinct(list(trim(coalesce(nullif(text, ''),
        regexp_extract(rtrim(split_part(href, '?', 1), '/'), '[^/]*$')))))) AS linked FROM links_t
        WHERE type = 'attachment' OR contains(href, '/download/attachments/') GROUP BY n),
att AS (SELECT corpus.n, coalesce(names, []::VARCHAR[]) AS names, coalesce(linked, []::VARCHAR[]) AS linked FROM corpus
        LEFT JOIN att_own ON att_own.page_id = corpus.page_id LEFT JOIN att_link ON att_link.n = corpus.n),
gap AS (SELECT n, list_sort(list_filter(linked, lambda x: NOT list_contains(names, x))) AS missing,
        list_sort(list_distinct(list_concat(names, linked))) AS referenced FROM att)"""
# links only: pages() without exported attachments
ATT_LINKS = "lk AS (SELECT n, count(DISTINCT href) AS attachment_count FROM links_t WHERE type = 'attachment' GROUP BY n)"

_PLACE = "lower(concat(title, chr(10), array_to_string(ancestor_titles, ' '), chr(10), text))"
_LP = any_sql("lower(concat(title, chr(10), text))", fv.LINKED_PROCEDURE_TERMS)
WARN = f"""
w0 AS (SELECT adj.*, coalesce(attachment_count, 0) AS attachment_count,
        document_type = 'runbook' AND {any_sql(_PLACE, fv.PROCEDURAL_TERMS)} AND NOT {any_sql(_PLACE, fv.NON_PROCEDURAL_TERMS)} AS rb,
        link_count > 0 AND {_LP} AS lkd FROM adj LEFT JOIN lk USING (n)),
warn AS (SELECT *, list_filter([
        CASE WHEN list_contains(flags, 'deprecated') OR list_contains(flags, 'archived') THEN 'source_is_archived_or_deprecated' END,
        CASE WHEN tot2 < 50 THEN 'low_quality_score' END, CASE WHEN NOT has_owner THEN 'missing_explicit_owner' END,
        CASE WHEN rb AND NOT has_validation_steps THEN 'missing_validation_steps' END,
        CASE WHEN rb AND NOT has_backout_steps THEN (CASE WHEN lkd THEN 'linked_procedure_not_expanded' ELSE 'missing_backout_steps' END) END,
        CASE WHEN attachment_count > 0 THEN 'attachments_present_not_parsed' END], lambda x: x IS NOT NULL) AS warnings FROM w0)"""

_MAIL = "concat(title, chr(10), array_to_string(labels, ' '), chr(10), text, chr(10), hrefs)"


def sens_cte(source: str) -> str:
    return f"""
e0 AS (SELECT *, {_MAIL} AS said FROM {source}),
e1 AS (SELECT *, regexp_extract_all(said, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}\\b') AS mails,
        regexp_matches(said, '\\bEMP-[A-Z0-9]{{4,}}\\b') AS pid,
        {any_sql('lower(said)', fv.LOG_LINK_TERMS)} AS logs FROM e0),
e2 AS (SELECT *, len(list_filter(mails, lambda m: NOT ends_with(lower(m), 'corp.example'))) > 0 AS outs FROM e1),
e3 AS (SELECT *, {any_sql('lower(said)', fv.CUSTOMER_CASE_TERMS)} AND (outs OR pid OR logs) AS cse FROM e2),
sens AS (SELECT * EXCLUDE (said), list_filter([CASE WHEN cse THEN 'contains_customer_case_data' END,
        CASE WHEN outs THEN 'contains_customer_emails' END, CASE WHEN len(mails) > 0 THEN 'contains_email_addresses' END,
        CASE WHEN logs THEN 'contains_log_links' END, CASE WHEN pid THEN 'contains_person_identifiers' END,
        CASE WHEN outs OR pid OR cse THEN 'requires_restricted_audience' END], lambda x: x IS NOT NULL) AS sflags FROM e3)"""


def _class_sql(c: str) -> str:
    return (
        f"CASE WHEN list_contains({c}, 'requires_restricted_audience') THEN 'restricted_internal' ELSE 'internal' END AS audience, "
        f"CASE WHEN list_contains({c}, 'contains_customer_case_data') THEN 'customer_confidential' "
        f"WHEN list_contains({c}, 'contains_customer_emails') OR list_contains({c}, 'contains_person_identifiers') THEN 'restricted' "
        "ELSE 'internal' END AS sensitivity"
    )


_NAMED = r"(?i)\b(\d{1,2})[\s/-]+(jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*[\s/-]+(20\d{2})\b"
_NUM = r"\b(20\d{2})-(\d{1,2})-(\d{1,2})\b"
FUTURE = (
    f"(len(list_filter(regexp_extract_all(text, {q(_NAMED)}), lambda m: try_strptime(concat(regexp_extract(m, {q(_NAMED)}, 3), '-', "
    f"lower(substr(regexp_extract(m, {q(_NAMED)}, 2), 1, 3)), '-', regexp_extract(m, {q(_NAMED)}, 1)), '%Y-%b-%d')::DATE > DATE '2024-01-30')) > 0 "
    f"OR len(list_filter(regexp_extract_all(text, {q(_NUM)}), lambda m: try_strptime(m, '%Y-%m-%d')::DATE > DATE '2024-01-30')) > 0)"
)


def trust_cte(source: str) -> str:
    seen = "lower(concat(title, chr(10), array_to_string(labels, ' '), chr(10), text))"
    return f"""
t0 AS (SELECT *, {seen} AS seen, {FUTURE} AS fut FROM {source}),
t1 AS (SELECT *, regexp_matches(lower(title), {q(fv.DRAFT_TITLE)}) OR contains(seen, 'status draft') AS dr,
        contains(lower(title), 'wip') OR contains(seen, 'work in progress') AS wi, {any_sql('seen', fv.UNRESOLVED_TERMS)} AS op_,
        (document_type = 'runbook' OR coalesce(document_subtype IN ('installation_guide', 'rollback_procedure', 'failover_procedure', 'release_report'), false)
         OR {any_sql('lower(title)', fv.VERSIONED_TITLE_TERMS)}) AND regexp_matches(lower(title), '\\b\\d+\\.\\d+(?:\\.\\d+)?\\b') AS ver,
        contains(lower(title), 'internal') OR contains(lower(array_to_string(labels, ' ')), ' internal') AS inte FROM t0),
tru AS (SELECT * EXCLUDE (seen), list_sort(list_filter([CASE WHEN dr THEN 'draft' END, CASE WHEN dr OR wi THEN 'not_for_execution' END,
        CASE WHEN wi THEN 'wip' END, CASE WHEN inte THEN 'internal_only' END, CASE WHEN op_ THEN 'contains_unresolved_items' END,
        CASE WHEN ver THEN 'versioned_operational_document' END, CASE WHEN fut THEN 'future_dated' END,
        CASE WHEN fut THEN 'not_for_execution_until_verified' END,
        CASE WHEN dr OR wi OR op_ OR fut THEN 'manual_review_required' END], lambda x: x IS NOT NULL)) AS tflags FROM t1)"""


_SUFF = "(" + " OR ".join(f"ends_with(lower(split_part(x, '?', 1)), {q(s)})" for s in fv.HIGH_VALUE_SUFFIXES) + ")"


def missing_cte(source: str) -> str:
    return f"""
m0 AS (SELECT {source}.*, missing, len(regexp_extract_all(markdown, '!\\[[^\\]]*\\]\\([^)]+\\)')) AS im,
        {WORDS_SQL.format(c='text')} AS wc FROM {source} JOIN gap USING (n)),
m1 AS (SELECT *, im > 0 AND n % 12 = 1 AS comp, im > 0 AND n % 12 = 5 AS part, im > 0 AND n % 12 NOT IN (1, 5) AS abst FROM m0),
m2 AS (SELECT *, abst AND (im >= 3 OR wc < 150) AS poor, len(missing) > 0 AND (coalesce(document_subtype IN
        ('api_specification', 'performance_test_report'), false) OR len(list_filter(missing, lambda x: {_SUFF})) > 0
        OR document_type IN ('design', 'architecture')) AS imp FROM m1),
mis AS (SELECT *, list_sort(list_filter([CASE WHEN comp THEN 'visual_content_extracted' END,
        CASE WHEN part THEN 'visual_content_partially_extracted' END, CASE WHEN part OR abst THEN 'visual_content_missing' END,
        CASE WHEN part OR poor THEN 'visual_content_review_recommended' END,
        CASE WHEN len(missing) > 0 THEN 'attachment_content_missing' END,
        CASE WHEN imp THEN 'attachment_content_review_recommended' END,
        CASE WHEN part OR poor OR imp THEN 'manual_review_required' END], lambda x: x IS NOT NULL)) AS mflags FROM m2)"""


_LONG = "len(list_filter(string_split(markdown, chr(10)), lambda l: starts_with(ltrim(l), '|') AND length(l) > 1200))"
USAB = (
    f"CASE WHEN {_LONG} >= 3 THEN ['manual_review_required', 'source_contains_oversized_table_rows', 'table_rendering_review_recommended'] "
    f"WHEN {_LONG} > 0 THEN ['manual_review_required', 'source_contains_oversized_table_rows'] ELSE []::VARCHAR[] END"
)
FLAGS = [ATT, classify_ctes("corpus"), sens_cte("cls"), trust_cte("sens"), missing_cte("tru")]
REVIEW = f"""
rev AS (SELECT *, list_sort(list_distinct(list_concat(sflags, tflags, mflags, {USAB}, CASE WHEN contains(lower({BODY_SQL}),
        'no exportable body content') THEN ['no_exportable_body_content'] WHEN wc < 80 THEN ['thin_source_content']
        ELSE []::VARCHAR[] END))) AS review_flags FROM mis)"""


def J(c: str) -> str:
    return f"array_to_string({c}, '|')"


SCORE_CTES = [COUNTS, HIER, classify_ctes("hier"), status_ctes(), signals_cte("sta"), SCORES]

SQL = {
    "hierarchy_counts": with_corpus("SELECT * FROM counts", COUNTS),
    "hierarchy_context": with_corpus(
        f"""SELECT document_id, depth, root_title, parent_title, section_path, parent_context_type,
        {J('ctx')} AS ancestor_context_types, page_role, depth = 0 AS is_root_page,
        page_role IN ('index_page', 'runbook_index') AS is_index_page, child_count = 0 AS is_leaf_page FROM hier""",
        COUNTS, HIER,
    ),
    "classify_documents": with_corpus(
        "SELECT document_id, dtype AS document_type, round(confidence, 4) AS confidence FROM c2", classify_ctes("corpus")
    ),
    "document_subtypes": with_corpus(
        "SELECT document_id, document_type, document_subtype FROM cls", classify_ctes("corpus")
    ),
    "status_flags": with_corpus(
        f"SELECT document_id, {J('flags')} AS status_flags, historical, currentness FROM sta",
        classify_ctes("corpus"), status_ctes(),
    ),
    "operational_signals": with_corpus(
        f"SELECT document_id, {', '.join(fv.SIGNAL_TERMS)} FROM sgn", signals_cte("corpus")
    ),
    "parse_timestamps": with_corpus(
        f"SELECT document_id, epoch({TS})::BIGINT AS seconds, {AGE} AS age_days FROM corpus"
    ),
    "quality_scores": with_corpus(
        """SELECT document_id, fr AS freshness_score, au AS authority_score, co AS completeness_score,
        op AS operational_value_score, ow AS ownership_clarity_score, 100 - fr AS staleness_risk_score,
        cr AS contradiction_risk_score, total AS overall_score FROM qual""", *SCORE_CTES,
    ),
    "quality_adjust": with_corpus(
        """SELECT document_id, co2 AS completeness_score, au1 AS authority_score, op2 AS operational_value_score,
        ow2 AS ownership_clarity_score, tot2 AS overall_score, CASE WHEN tot2 >= 85 THEN 'excellent' WHEN tot2 >= 70 THEN 'good'
        WHEN tot2 >= 50 THEN 'fair' ELSE 'poor' END AS quality_band,
        round(least(0.95::DOUBLE, (confidence + tot2 / 100.0::DOUBLE) / 2), 6) AS confidence FROM adj""", *SCORE_CTES, ADJ,
    ),
    "quality_warnings": with_corpus(
        f"SELECT document_id, {J('warnings')} AS warnings FROM warn", *SCORE_CTES, ADJ, ATT_LINKS, WARN
    ),
    "sensitivity_flags": with_corpus(
        f"SELECT document_id, {J('sflags')} AS sensitivity_flags, {_class_sql('sflags')} FROM sens", sens_cte("corpus")
    ),
    "future_dates": with_corpus(f"SELECT document_id, {FUTURE} AS has_future_date FROM corpus"),
    "trust_flags": with_corpus(
        f"SELECT document_id, {J('tflags')} AS trust_flags FROM tru", classify_ctes("corpus"), trust_cte("cls")
    ),
    "missing_content_flags": with_corpus(
        f"SELECT document_id, {J('mflags')} AS missing_content_flags FROM mis", *FLAGS
    ),
    "usability_flags": with_corpus(f"SELECT document_id, {J(USAB)} AS usability_flags FROM corpus"),
    "review_flags_union": with_corpus(
        f"SELECT document_id, {J('review_flags')} AS review_flags, {_class_sql('review_flags')} FROM rev", *FLAGS, REVIEW
    ),
    "attachment_gap": with_corpus(
        f"""SELECT document_id, {J('missing')} AS missing_attachment_names, {J('referenced')} AS referenced_attachment_names,
        len(referenced) AS attachment_count FROM corpus JOIN gap USING (n)""", ATT,
    ),
}
