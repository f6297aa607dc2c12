"""Terms, entities, facts, opening text, summaries, text helpers."""

from __future__ import annotations

from checks.corpus import documents, pages, table, with_corpus
from checks.q_classify import (
    COUNTS, HIER, J, any_sql, classified, classify_ctes, profiled, q,
)
from checks.q_profile import BODY_SQL, HEADINGS_SQL
from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx
from corpuswright.operators import classify as cl
from corpuswright.operators import extract as ex
from corpuswright.operators import hierarchy as hi
from pyspark.sql import functions as F


def enriched_terms(spark, sf):
    df = cl.document_subtypes(cl.classify_documents(profiled(spark, sf)))
    return ex.with_keywords(df)


def entities(spark, sf):
    return ex.candidate_entities(ex.with_keywords(pages(spark, sf)))


def facts(spark, sf):
    # terms once: the entity table names the subjects
    return ex.candidate_facts(documents(spark, sf), entities(spark, sf))


def _summaries(spark, sf):
    df = ex.opening_text(enriched_terms(spark, sf))
    df = df.withColumn(
        "parent_title", F.when(F.size("ancestors") > 0, F.element_at(hi.ancestor_titles(F.col("ancestors")), -1))
    )
    return ex.summaries(df).select("document_id", "short_summary", F.sha2("detailed_summary", 256).alias("detailed"))


def _titles(spark, sf):
    """Short names from parts and page titles, with accents and signs."""
    html = table(spark, sf, "pages").select(F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("t"))
    parts = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("t"))
    return html.unionByName(parts).where("t <> ''").distinct()


def _term_lists(df):
    cols = ex.concepts(ex.themes(ex.categories(df)))
    return cols


QUERIES = {
    "normalize_terms": lambda s, d: _titles(s, d).select("t", tx.normalize_term(F.col("t")).alias("term")),
    "slugify": lambda s, d: _titles(s, d).select("t", tx.slugify(F.col("t"), 40).alias("slug")),
    "keyword_counts": lambda s, d: ex.keyword_counts(pages(s, d)),
    "taxonomy_terms": lambda s, d: documents(s, d).select(
        "document_id",
        ex.taxonomy_terms(F.concat(F.array("title"), F.col("labels"), F.split("title", " ")), limit=12).alias("terms"),
    ),
    "keywords": lambda s, d: ex.keywords(pages(s, d)),
    "themes": lambda s, d: ex.themes(enriched_terms(s, d)).select("document_id", "themes"),
    "concepts": lambda s, d: ex.concepts(enriched_terms(s, d)).select("document_id", "concepts"),
    "categories": lambda s, d: ex.categories(enriched_terms(s, d)).select("document_id", "categories"),
    "candidate_entities": lambda s, d: entities(s, d).select(
        "document_id", "rank", "entity_type", "normalized_name", "name", "confidence",
        F.size("mentions").alias("mention_count"),
        F.array_join(F.transform("mentions", lambda m: m["source_field"]), "|").alias("fields"),
    ),
    "entity_buckets": lambda s, d: ex.entity_buckets(entities(s, d)),
    "candidate_facts": facts,
    "opening_text": lambda s, d: ex.opening_text(documents(s, d)).select("document_id", "opening_text"),
    "summaries": _summaries,
    "display_titles": lambda s, d: documents(s, d).select(
        "document_id",
        tx.display_title(F.concat(F.expr("concat(n % 4, '.', n % 7, ' ')"), "title")).alias("shown"),
    ),
    "rewrite_images": lambda s, d: documents(s, d).select(
        "document_id", F.sha2(tx.rewrite_images(F.col("markdown")), 256).alias("body_sha")
    ),
    "first_seen_dedupe": lambda s, d: ex.first_seen_dedupe(
        table(s, d, "conversations").select(
            "conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "word")
        ),
        "conv_id", ["turn", "pos"], "word", limit=40,
    ),
}

NORM = "trim(regexp_replace(lower(regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', ' ', 'g'))"
PLAIN = "trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'))"
_TITLES = """t0 AS (SELECT DISTINCT t FROM (SELECT regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages
    UNION ALL SELECT concat_ws(' ', p_name, p_brand, p_type) FROM part) WHERE t <> '')"""


def strings(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def clean_sql(c: str) -> str:
    many = f"trim(regexp_replace({NORM.format(c=c)}, '^(?:\\d+\\s+){{2,}}', ''))"
    return f"trim(regexp_replace({many}, '^\\d+\\s+([a-z])', '\\1'))"


def useful_sql(v: str) -> str:
    words = f"string_split({v}, ' ')"
    return (
        f"({v} <> '' AND NOT list_contains({strings(fv.GENERIC_TAXONOMY_TERMS)}, {v}) AND NOT starts_with({v}, 'http ') "
        f"AND NOT starts_with({v}, 'https ') AND NOT contains(concat(' ', {v}, ' '), ' http ') "
        f"AND NOT {any_sql(v, fv.NOISY_TAXONOMY_FRAGMENTS)} "
        f"AND NOT (len(list_filter({words}, lambda w: regexp_full_match(w, '\\d+'))) >= 3 AND len({words}) >= 6) "
        f"AND (len({words}) > 1 OR list_contains({strings(fv.SHORT_TERMS_KEPT)}, {v}) OR length({v}) >= 5) "
        f"AND (list_contains({strings(fv.SHORT_TERMS_KEPT)}, {v}) OR length({v}) >= 4))"
    )


def first_seen(arr: str) -> str:
    """Distinct in order."""
    return f"list_filter({arr}, lambda x, i: list_position({arr}, x) = i)"


def taxonomy_ctes(source: str, key: str, arr: str, name: str, limit: int | None = None) -> str:
    cut = f"[1:{limit}]" if limit else ""
    return f"""
{name}_a AS (SELECT {key}, list_filter(list_transform({arr}, lambda v: {clean_sql('v')}), lambda v: {useful_sql('v')}) AS a FROM {source}),
{name} AS (SELECT {key}, ({first_seen('a')}){cut} AS terms FROM {name}_a)"""


KW = f"""
lt20 AS (SELECT n, string_agg(coalesce(text, ''), chr(10) ORDER BY pos) AS texts FROM
        links_t GROUP BY n),
ksrc AS (SELECT document_id, concat(title, chr(10), array_to_string(labels, ' '), chr(10),
        array_to_string(({HEADINGS_SQL}), ' '), coalesce(chr(10) || texts, '')) AS s FROM corpus LEFT JOIN lt20 USING (n)),
kfind AS (SELECT document_id, regexp_extract_all(s, '[A-Za-z][A-Za-z0-9_+./-]{{2,}}') AS a,
        regexp_extract_all(regexp_replace(s, '[^\\x00-\\x7F]', '_', 'g'), '\\b[A-Z][A-Za-z0-9]+(?:\\s+[A-Z][A-Za-z0-9]+){{0,3}}\\b') AS b FROM ksrc),
kraw AS (SELECT document_id, {PLAIN.format(c='a[i]')} AS term, 1 AS w, i AS pos FROM kfind, unnest(range(1, len(a) + 1)) u(i)
        UNION ALL SELECT document_id, {PLAIN.format(c='b[i]')}, 2, i + 16777216 FROM kfind, unnest(range(1, len(b) + 1)) u(i)),
kcnt AS (SELECT document_id, term, sum(w) AS weight, min(pos) AS pos FROM kraw WHERE term <> ''
        AND NOT list_contains({strings(fv.STOPWORDS)}, term) AND (w = 2 OR length(term) >= 3) GROUP BY ALL),
krank AS (SELECT document_id, term, weight::BIGINT AS weight, row_number() OVER (PARTITION BY document_id ORDER BY weight DESC, pos) AS rank
        FROM kcnt),
klist AS (SELECT document_id, list(term ORDER BY rank) AS l FROM krank GROUP BY document_id)""" + "," + taxonomy_ctes(
    "klist", "document_id", "l", "kw"
)
KWDOC = "kdoc AS (SELECT cls.*, coalesce(kw.terms, []::VARCHAR[]) AS keywords FROM cls LEFT JOIN kw USING (document_id))"


def _norm_list(arr: str) -> str:
    return f"list_transform({arr}, lambda v: {NORM.format(c='v')})"


_TH = f"list_concat([document_type], {_norm_list('ancestor_titles[-2:]')}, keywords)"
_CO = f"list_concat({_norm_list(f'({HEADINGS_SQL})')}, keywords)"
_CA = f"list_filter({_norm_list('list_concat([document_type, space_key], labels, keywords)')}, lambda v: v <> '')"

_HINTS = " ".join(f"WHEN {any_sql('nn', t)} THEN {q(k)}" for k, t in fv.ENTITY_HINTS.items())
ENT = f"""
ekw AS (SELECT corpus.document_id, corpus.n, page_id, title, labels, coalesce(kw.terms, []::VARCHAR[]) AS keywords
        FROM corpus LEFT JOIN kw USING (document_id)),
etitle AS (SELECT document_id, regexp_extract_all(title, '[A-Z][A-Za-z0-9+.-]{{2,}}(?:\\s+[A-Z][A-Za-z0-9+.-]{{2,}}){{0,3}}') AS a FROM ekw),
eraw AS (SELECT document_id, a[i] AS raw, 'title' AS f, i AS pos FROM etitle, unnest(range(1, len(a) + 1)) u(i)
  UNION ALL SELECT document_id, labels[i], 'label', 1000000 + i FROM ekw, unnest(range(1, len(labels) + 1)) u(i)
  UNION ALL SELECT document_id, keywords[i], 'keyword', 2000000 + i FROM ekw, unnest(range(1, len(keywords) + 1)) u(i)
  UNION ALL SELECT document_id, coalesce(target_title, text), CASE WHEN target_title IS NULL THEN 'link_text' ELSE 'link_target_title' END,
        3000000 + pos FROM links_t JOIN ekw USING (n) WHERE target_title IS NOT NULL OR (text IS NOT NULL AND text <> '' AND length(text) <= 80)),
ename AS (SELECT document_id, f, pos, trim(regexp_replace(raw, '\\s+', ' ', 'g'), ' -_#') AS name FROM eraw),
enorm AS (SELECT *, {NORM.format(c='name')} AS nn FROM ename),
etype AS (SELECT *, CASE WHEN regexp_matches(name, '(?i)^https?://') THEN 'url'
        WHEN regexp_full_match(name, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}') THEN 'contact' {_HINTS}
        WHEN f = 'title' AND regexp_matches(regexp_replace(name, '[^\\x00-\\x7F]', '_', 'g'), '\\b[A-Z]{{2,}}[A-Z0-9-]*\\b') THEN 'application'
        WHEN {any_sql('nn', ['team', 'support', 'sre', 'l2', 'l3'])} THEN 'support_group'
        WHEN regexp_matches(name, '(?i)\\b(INC|CHG|RITM|DOC)-?\\d+\\b') THEN (CASE WHEN contains(nn, 'inc') THEN 'incident' ELSE 'change_record' END)
        ELSE 'technology' END AS entity_type FROM enorm WHERE length(nn) >= 3
        AND NOT list_contains({strings(fv.STOPWORDS + fv.GENERIC_ENTITY_TERMS)}, nn) AND (f <> 'keyword' OR contains(nn, ' '))),
emerge AS (SELECT document_id, entity_type, nn AS normalized_name, arg_min(name, pos) AS name, arg_min(f, pos) AS f0,
        count(*) AS mention_count, string_agg(f, '|' ORDER BY pos) AS fields, list({{'f': f, 'e': name}} ORDER BY pos) AS ms FROM etype GROUP BY ALL),
ent AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY entity_type, normalized_name) AS rank FROM emerge)"""

_PATS = ", ".join(
    f"({i}, {q(p)}, {q('(?i)' + r)}, {c}::DOUBLE)" for i, (p, _, r, c) in enumerate(fv.FACT_PATTERNS)
)
_COMP = ", ".join(f"({25 + i}, {q(p)}, {q('(?i)' + r)}, {c}::DOUBLE)" for i, (p, r, c) in enumerate(fv.FACT_COMPOSITE))
_STEP = ", ".join(f"({27 + i}, {q(p)}, {q(r)}, {c}::DOUBLE)" for i, (p, _, r, c) in enumerate(fv.FACT_STEPS))
_CLAIM = "CASE " + " ".join(
    f"WHEN predicate IN ({', '.join(q(p) for p in ps)}) THEN {q(k)}" for k, ps in fv.CLAIM_TYPES.items()
) + " ELSE 'unknown' END"
FACT = f"""
pats AS (SELECT * FROM (VALUES {_PATS}) v(spec, predicate, pat, confidence)),
comps AS (SELECT * FROM (VALUES {_COMP}) v(spec, predicate, pat, confidence)),
steps AS (SELECT * FROM (VALUES {_STEP}) v(spec, predicate, pat, confidence)),
fl0 AS (SELECT document_id, list_filter(list_transform(list_concat(string_split({BODY_SQL}, chr(10)), string_split(text, chr(10))),
        lambda l: trim(l)), lambda l: l <> '') AS ls, string_split(regexp_replace(text, '([.;])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS ss FROM corpus),
fl1 AS (SELECT document_id, CASE WHEN len(ls) <= 2 THEN list_concat(ls, ss) ELSE ls END AS ls FROM fl0),
fl2 AS (SELECT document_id, i AS line_no, regexp_replace(trim(ls[i]), '\\s+', ' ', 'g') AS line FROM fl1, unnest(range(1, len(ls) + 1)) u(i)),
fl3 AS (SELECT *, lower(line) AS low FROM fl2 WHERE NOT starts_with(line, '#') AND length(line) >= 12),
fraw AS (SELECT document_id, line_no, line, spec, predicate, confidence, regexp_extract(line, pat, 1) AS v FROM fl3, pats
   UNION ALL SELECT document_id, line_no, line, spec, predicate, confidence, regexp_extract(line, pat, 1) FROM fl3, comps
        WHERE contains(low, 'owner') AND contains(low, 'support group')
   UNION ALL SELECT document_id, line_no, line, spec, predicate, confidence, line FROM fl3, steps
        WHERE regexp_matches(regexp_replace(low, '[^\\x00-\\x7F]', '_', 'g'), pat)),
fobj AS (SELECT *, trim(regexp_replace(v, '\\s+', ' ', 'g'), ' :-|.;') AS object FROM fraw WHERE v <> ''),
fkey AS (SELECT *, {NORM.format(c='object')} AS k, line AS ev FROM fobj WHERE object <> '' AND lower(object) NOT IN ('none', 'n/a', 'unknown', 'tbd')),
ffirst AS (SELECT * FROM fkey QUALIFY row_number() OVER (PARTITION BY document_id, predicate, k, ev ORDER BY line_no, spec) = 1),
fstop AS (SELECT *, coalesce(count(*) OVER (PARTITION BY document_id ORDER BY line_no RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM ffirst),
fact AS (SELECT f.document_id, row_number() OVER (PARTITION BY f.document_id ORDER BY line_no, spec) AS ordinal, predicate,
        {_CLAIM} AS claim_type, object, f.confidence, line AS evidence_text, coalesce(ent.name, corpus.title) AS subject
        FROM fstop f JOIN corpus USING (document_id) LEFT JOIN ent ON ent.document_id = f.document_id AND ent.rank = 1)"""

_CLEANED = (
    "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '!\\[[^\\]]*\\]\\([^)]+\\)', '', 'g'), "
    "'\\[([^\\]]+)\\]\\([^)]+\\)', '\\1', 'g'), '[*_`]+', '', 'g'), '\\s+', ' ', 'g'), ' -|')"
)
OPEN = f"""
o0 AS (SELECT document_id, title, list_filter(list_transform(list_filter(list_transform(string_split({BODY_SQL}, chr(10)), lambda l: trim(l)),
        lambda l: l <> '' AND NOT starts_with(l, '#') AND NOT starts_with(l, '_Source: ') AND l <> '---' AND NOT starts_with(l, '| ---')),
        lambda l: {_CLEANED.format(c='l')}), lambda l: l <> '') AS ls FROM corpus),
o1 AS (SELECT document_id, title, CASE WHEN len(ls) = 0 THEN title ELSE list_reduce(ls, lambda a, l: CASE WHEN length(a) >= 260 THEN a
        ELSE concat(a, ' ', l) END) END AS o FROM o0),
o2 AS (SELECT document_id, split_part(regexp_replace(o, '([.!?])\\s+', '\\1' || chr(1)), chr(1), 1) AS o FROM o1),
opn AS (SELECT document_id, CASE WHEN length(o) <= 260 THEN o ELSE coalesce(nullif(rtrim(regexp_replace(substr(o, 1, 260), ' [^ ]*$', ''), ' .,;:-'), ''),
        rtrim(substr(o, 1, 260), ' .,;:-')) END AS opening_text FROM o2)"""
SUMM = f"""
sm AS (SELECT kdoc.*, opening_text, {HEADINGS_SQL} AS hs, CASE WHEN len(ancestor_titles) > 0 THEN ancestor_titles[-1] END AS par FROM kdoc JOIN opn USING (document_id))"""

_SHOWN = "trim(regexp_replace(concat(n % 4, '.', n % 7, ' ', title), '^\\s*\\d+(?:\\.\\d+)*\\.?\\s+', ''))"
SQL = {
    "normalize_terms": f"WITH {_TITLES} SELECT t, {NORM.format(c='t')} AS term FROM t0",
    "slugify": f"""WITH {_TITLES} SELECT t, coalesce(nullif(rtrim(substr(replace({NORM.format(c='t')}, ' ', '-'), 1, 40), '-'), ''), 'untitled')
        AS slug FROM t0""",
    "keyword_counts": with_corpus("SELECT * FROM krank", KW),
    "taxonomy_terms": with_corpus(
        f"SELECT document_id, {J('terms')} AS terms FROM tt",
        taxonomy_ctes("corpus", "document_id", "list_concat([title], labels, string_split(title, ' '))", "tt", 12),
    ),
    "keywords": with_corpus(f"SELECT document_id, {J('terms')} AS keywords FROM kw", KW),
    "themes": with_corpus(
        f"SELECT document_id, {J('terms')} AS themes FROM th", KW, classify_ctes("corpus"), KWDOC,
        taxonomy_ctes("kdoc", "document_id", _TH, "th"),
    ),
    "concepts": with_corpus(
        f"SELECT document_id, {J('terms')} AS concepts FROM co", KW, classify_ctes("corpus"), KWDOC,
        taxonomy_ctes("kdoc", "document_id", _CO, "co"),
    ),
    "categories": with_corpus(
        f"SELECT document_id, {J(first_seen('a'))} AS categories FROM (SELECT document_id, {_CA} AS a FROM kdoc)",
        KW, classify_ctes("corpus"), KWDOC,
    ),
    "candidate_entities": with_corpus(
        """SELECT document_id, rank, entity_type, normalized_name, name,
        CASE WHEN f0 = 'title' THEN 0.75 ELSE 0.6 END::DOUBLE AS confidence, mention_count, fields FROM ent""", KW, ENT,
    ),
    "entity_buckets": with_corpus(
        "SELECT document_id, "
        + ", ".join(
            "coalesce(array_to_string(list_sort(list(DISTINCT name) FILTER (entity_type "
            + (f"= {q(k)}" if k else "NOT IN ('application', 'support_group', 'dashboard', 'database', 'queue', 'api')")
            + f")), '|'), '') AS {b}"
            for b, k in fv.ENTITY_BUCKETS.items() if b != "teams"
        )
        + ", '' AS teams FROM ent GROUP BY document_id", KW, ENT,
    ),
    "candidate_facts": with_corpus("SELECT * FROM fact", KW, ENT, FACT),
    "opening_text": with_corpus("SELECT document_id, opening_text FROM opn", OPEN),
    "summaries": with_corpus(
        """SELECT document_id, concat(title, ' [', concat_ws(', ', document_type, document_subtype), ']',
        CASE WHEN par IS NULL THEN '' ELSE concat('; below: ', par) END) AS short_summary,
        sha256(concat('Begins: ', opening_text, ' | Sections: ', CASE WHEN len(hs) > 0 THEN array_to_string(hs[1:4], '; ') ELSE 'none' END,
        ' | Keywords: ', CASE WHEN len(keywords) > 0 THEN array_to_string(keywords[1:8], '; ') ELSE 'none' END,
        ' | Kind and keywords by rule')) AS detailed
        FROM sm""", KW, classify_ctes("corpus"), KWDOC, OPEN, SUMM,
    ),
    "display_titles": with_corpus(
        f"SELECT document_id, CASE WHEN {_SHOWN} = '' THEN concat(n % 4, '.', n % 7, ' ', title) ELSE {_SHOWN} END AS shown FROM corpus"
    ),
    "rewrite_images": with_corpus(
        """SELECT document_id, sha256(regexp_replace(regexp_replace(markdown, '!\\[\\]\\((?:[^)?]*/)?([^)?/]+)(?:\\?[^)]*)?\\)',
        '> Image omitted from source export: \\1', 'g'), '!\\[([^\\]]+)\\]\\([^)]+\\)', '> Image omitted from source export: \\1', 'g')) AS body_sha FROM corpus"""
    ),
    "first_seen_dedupe": f"""WITH w0 AS (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations),
        w1 AS (SELECT conv_id, turn, i AS pos, ws[i] AS word FROM w0, unnest(range(1, len(ws) + 1)) u(i)),
        w2 AS (SELECT *, {NORM.format(c='word')} AS k FROM w1),
        w3 AS (SELECT * FROM w2 WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY conv_id, k ORDER BY turn, pos) = 1)
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) AS rank, trim(word) AS word FROM w3 QUALIFY rank <= 40""",
}
