from __future__ import annotations

from checks.corpus import documents, index_rows, index_sql, pages, with_corpus
from checks.q_profile import simhash_sql
from corpuswright.operators import duplicates as dup
from corpuswright.operators import profile as p
from corpuswright.functions import text as tx
from corpuswright.operators import rollups as ro
from checks.q_extract import NORM
from checks.q_profile import HEADINGS_SQL
from pyspark.sql import functions as F


def _sigs(spark, sf):
    return p.simhash64(documents(spark, sf), "text").withColumnRenamed("simhash", "text_simhash")


def _heading_sigs(spark, sf):
    """Heading signatures of the documents that have headings."""
    docs = documents(spark, sf).withColumn("headings", tx.extract_headings(F.col("markdown")))
    joined = docs.where(F.size("headings") > 0).withColumn("joined", F.array_join("headings", " "))
    return p.simhash64(joined, "joined").withColumnRenamed("simhash", "heading_simhash")


def _families(spark, sf):
    docs = index_rows(spark, sf)
    return dup.title_families(docs)


def _group_choice(spark, sf):
    docs = index_rows(spark, sf)
    members = dup.group_members(docs).where("reason = 'normalized_title'")
    return dup.member_choice(members, docs, ["group_key"]).where("members > 1")


def _hamming(spark, sf):
    sigs = _sigs(spark, sf).select(F.col("document_id"), "text_simhash")
    other = F.lpad(F.hex(F.expr("cast(split(document_id, ':')[2] as bigint) * 7919")), 16, "0")
    return sigs.select("document_id", tx.hamming(F.col("text_simhash"), F.lower(other)).alias("distance"))


def _token_ops(spark, sf):
    shared, joined = ro.title_token_ops(F.col("title"), F.expr("concat(title, ' ', space_key, ' runbook')"))
    return documents(spark, sf).select("document_id", shared.alias("shared"), joined.alias("joined"))


QUERIES = {
    "simhash_pairs": lambda s, d: dup.simhash_pairs(_sigs(s, d)),
    "heading_simhash_pairs": lambda s, d: dup.simhash_pairs(_heading_sigs(s, d), "heading_simhash"),
    "simhash_groups": lambda s, d: dup.simhash_groups(_sigs(s, d)),
    "hamming": _hamming,
    "title_token_ops": _token_ops,
    "near_title_pairs": lambda s, d: dup.near_title_pairs(documents(s, d)).select(
        F.round("similarity", 6).alias("similarity"), "left_docs", "right_docs",
        F.least("left_doc", "right_doc").alias("doc_a"), F.greatest("left_doc", "right_doc").alias("doc_b"),
    ),
    "near_title_links": lambda s, d: dup.near_title_links(documents(s, d)),
    "duplicate_groups": lambda s, d: dup.duplicate_groups(index_rows(s, d)),
    "title_families": _families,
    "duplicate_clusters": lambda s, d: dup.duplicate_clusters(index_rows(s, d)),
    "family_metadata": lambda s, d: dup.family_metadata(_families(s, d), index_rows(s, d), ["family_id"]),
    "duplicate_keeper": lambda s, d: _group_choice(s, d).select("group_key", "members", "keeper"),
    "latest_member": lambda s, d: _group_choice(s, d).select("group_key", "latest"),
    "latest_production_member": lambda s, d: _group_choice(s, d).select("group_key", "latest_production"),
}

TOK = f"list_sort(list_distinct(list_filter(string_split({NORM.format(c='title')}, ' '), lambda w: w <> '')))"
SETS = f"""
ts AS (SELECT document_id, {TOK} AS toks FROM base),
tg AS (SELECT toks, count(*) AS docs, min(document_id) AS doc FROM ts WHERE len(toks) >= 2 GROUP BY toks),
tp AS (SELECT a.toks AS lset, b.toks AS rset, a.doc AS ad, b.doc AS bd, a.docs AS an, b.docs AS bn,
        len(list_intersect(a.toks, b.toks))::DOUBLE / len(list_distinct(list_concat(a.toks, b.toks))) AS sim
        FROM tg a JOIN tg b ON a.toks < b.toks AND least(len(a.toks), len(b.toks)) >= 0.8 * greatest(len(a.toks), len(b.toks)))"""
FAMS = """
fe AS (SELECT lset AS a, rset AS b FROM tp WHERE sim >= 0.8 AND len(lset) >= 3 AND len(rset) >= 3
        UNION SELECT rset, lset FROM tp WHERE sim >= 0.8 AND len(lset) >= 3 AND len(rset) >= 3),
fn AS (SELECT DISTINCT toks FROM ts WHERE len(toks) >= 3),
fr(a, b) AS (SELECT toks, toks FROM fn UNION SELECT fr.a, fe.b FROM fr JOIN fe ON fr.b = fe.a),
fc AS (SELECT a AS toks, min(b) AS comp FROM fr GROUP BY a),
fm AS (SELECT document_id, comp FROM ts JOIN fc USING (toks)),
fam AS (SELECT min(document_id) OVER (PARTITION BY comp) AS family_id, document_id, count(*) OVER (PARTITION BY comp) AS members FROM fm
        QUALIFY members >= 3)"""
LINKS = """
le AS (SELECT lset AS a, rset AS b FROM tp WHERE sim >= 0.8 UNION SELECT rset, lset FROM tp WHERE sim >= 0.8),
lr(a, b) AS (SELECT toks, toks FROM tg UNION SELECT lr.a, le.b FROM lr JOIN le ON lr.b = le.a),
lc AS (SELECT a AS toks, min(doc) AS class_id FROM lr JOIN tg ON tg.toks = lr.b GROUP BY a),
ln AS (SELECT a AS toks, count(*) AS links FROM le GROUP BY a)"""
LAB = "concat(space_key, ':', page_id, ' ', title)"


def _meta(source: str, keys: str) -> str:
    return f"""
fx AS (SELECT {keys}, lower(title) AS t FROM {source} JOIN idx USING (document_id)),
fv0 AS (SELECT {keys}, list_sort(list_distinct(flatten(list(regexp_extract_all(t, '\\b\\d+\\.\\d+(?:\\.\\d+)?\\b'))))) AS v,
   list_filter([CASE WHEN bool_or(contains(t, 'dev')) THEN 'DEV' END, CASE WHEN bool_or(contains(t, 'ppe')) THEN 'PPE' END,
        CASE WHEN bool_or(contains(t, 'prod')) THEN 'PROD' END, CASE WHEN bool_or(contains(t, 'qa')) THEN 'QA' END], lambda x: x IS NOT NULL) AS e,
   list_filter([CASE WHEN bool_or(regexp_matches(t, '\\bapse1\\b|ap-southeast-1')) THEN 'ap-southeast-1' END,
        CASE WHEN bool_or(regexp_matches(t, '\\beuw1\\b|eu-west-1')) THEN 'eu-west-1' END,
        CASE WHEN bool_or(regexp_matches(t, '\\buse1\\b|us-east-1')) THEN 'us-east-1' END], lambda x: x IS NOT NULL) AS r FROM fx GROUP BY {keys}),
fmeta AS (SELECT {keys}, CASE WHEN len(v) > 1 THEN 'version_series' WHEN len(r) > 1 THEN 'regional_variant' WHEN len(e) > 1
        THEN 'environment_variant' ELSE 'true_duplicate' END AS family_type,
        CASE WHEN len(v) > 0 THEN array_to_string(v, ', ') ELSE '-' END AS versions,
        CASE WHEN len(e) > 0 THEN array_to_string(e, ', ') ELSE '-' END AS environments,
        CASE WHEN len(r) > 0 THEN array_to_string(r, ', ') ELSE '-' END AS regions FROM fv0)"""


def _choice(source: str, keys: str) -> str:
    return f"""
mc AS (SELECT {keys}, idx.*, {LAB} AS label FROM {source} JOIN idx USING (document_id)),
mk AS (SELECT {keys}, label AS keeper FROM mc QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY
        (NOT list_contains(status_flags, 'archived') AND NOT list_contains(status_flags, 'deprecated')) DESC,
        (document_type IN ('runbook', 'support_model', 'architecture', 'knowledge_article')) DESC,
        coalesce(source_updated_at, '') DESC, word_count DESC, space_key, page_id) = 1),
ml AS (SELECT {keys}, label AS latest, count(*) OVER (PARTITION BY {keys}) AS members FROM mc
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY coalesce(source_updated_at, '') DESC, page_id DESC) = 1),
mp AS (SELECT {keys}, label AS latest_production FROM mc WHERE regexp_matches(title, '(?i)\\bprod(?:uction)?\\b')
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY coalesce(source_updated_at, '') DESC, page_id DESC) = 1)"""


_TITLE_GROUPS = f"tgm AS (SELECT {NORM.format(c='title')} AS group_key, document_id FROM idx WHERE {NORM.format(c='title')} <> '')"
_NOISE = "['ppe','prod','production','dev','qa','use1','euw1','apse1','east','west','southeast','us','eu','ap','hotfix','fix']"
CLUSTER = f"""
gm AS (SELECT 'content_hash' AS reason, source_content_hash AS group_key, '' AS part, document_id FROM idx
   UNION ALL SELECT 'normalized_title', {NORM.format(c='title')}, '', document_id FROM idx WHERE {NORM.format(c='title')} <> ''),
ct AS (SELECT family_id, document_id, members, list_filter({TOK}, lambda w: NOT list_contains({_NOISE}, w)) AS w FROM fam JOIN idx USING (document_id)),
cw AS (SELECT family_id, members, unnest(w) AS w FROM ct),
cc AS (SELECT family_id, w FROM cw GROUP BY family_id, members, w HAVING count(*) = members),
ck AS (SELECT family_id, string_agg(w, ' ' ORDER BY w) AS common FROM cc GROUP BY family_id),
cf AS (SELECT family_id, arg_min({NORM.format(c='title')}, (space_key, page_id)) AS ft FROM fam JOIN idx USING (document_id) GROUP BY family_id),
fk AS (SELECT family_id, coalesce(common, ft) AS family_key FROM cf LEFT JOIN ck USING (family_id)),
gall AS (SELECT * FROM gm UNION ALL SELECT 'near_title_family', family_key, family_id, document_id FROM fam JOIN fk USING (family_id)),
gset AS (SELECT reason, group_key, part, list_sort(list(concat(space_key, ':', page_id))) AS ks, arg_min(title, (space_key, page_id)) AS first_title
        FROM gall JOIN idx USING (document_id) GROUP BY ALL HAVING count(*) > 1),
gone AS (SELECT * FROM gset QUALIFY row_number() OVER (PARTITION BY ks ORDER BY reason, group_key, part) = 1),
gmem AS (SELECT gall.* FROM gall JOIN gone USING (reason, group_key, part))"""
# upper-case the first letter of every run of letters
_CAP = """array_to_string(list_transform(regexp_extract_all(lower({c}), '[\\p{{L}}]+|[^\\p{{L}}]+'), lambda r: concat(upper(r[1]), r[2:])), '')"""
_LABEL = _CAP.format(c="array_to_string(list_filter(string_split(group_key, ' '), lambda w: NOT regexp_full_match(w, '\\d+')), ' ')")

_SIG = simhash_sql("corpus", "document_id", "text", "sig")
_PAIRS = """SELECT a.simhash AS left_simhash, b.simhash AS right_simhash, bit_count(xor(a.v, b.v))::BIGINT AS distance,
           a.doc AS left_doc, b.doc AS right_doc, a.docs AS left_docs, b.docs AS right_docs
           FROM g a JOIN g b ON (a.simhash < b.simhash AND bit_count(xor(a.v, b.v)) <= 6)
                              OR (a.simhash = b.simhash AND a.docs > 1)"""
_G = "g AS (SELECT simhash, v::UBIGINT AS v, min(document_id) AS doc, count(*) AS docs FROM sig GROUP BY ALL)"
SQL = {
    "simhash_groups": with_corpus("SELECT simhash, document_id FROM sig", _SIG),
    "simhash_pairs": with_corpus(_PAIRS, _SIG, _G),
    "heading_simhash_pairs": with_corpus(
        _PAIRS,
        f"heads AS (SELECT document_id, array_to_string({HEADINGS_SQL}, ' ') AS hd FROM base WHERE len({HEADINGS_SQL}) > 0)",
        simhash_sql("heads", "document_id", "hd", "sig"), _G,
    ),
    "hamming": with_corpus(
        "SELECT sig.document_id, bit_count(xor(v::UBIGINT, (n * 7919)::UBIGINT))::BIGINT AS distance FROM sig JOIN base USING (document_id)", _SIG
    ),
    "title_token_ops": with_corpus(
        """SELECT document_id, array_to_string(list_filter(w, lambda x: list_contains(x2, x)), '|') AS shared,
        array_to_string(list_concat(w, list_filter(x2, lambda x: NOT list_contains(w, x))), '|') AS joined FROM
        (SELECT document_id, list_filter(w, lambda x, i: x <> '' AND list_position(w, x) = i) AS w, list_filter(x2, lambda x, i: x <> '' AND list_position(x2, x) = i) AS x2
        FROM (SELECT document_id, string_split(%s, ' ') AS w, string_split(%s, ' ') AS x2 FROM base))"""
        % (NORM.format(c="title"), NORM.format(c="concat(title, ' ', space_key, ' runbook')"))
    ),
    "near_title_links": with_corpus(
        "SELECT document_id, class_id, coalesce(links, 0) AS links, docs - 1 AS copies FROM ts JOIN tg USING (toks) JOIN lc USING (toks) LEFT JOIN ln USING (toks)",
        SETS, LINKS,
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "near_title_pairs": with_corpus(
        """SELECT round(sim, 6) AS similarity, CASE WHEN sha256(array_to_string(lset, ' ')) < sha256(array_to_string(rset, ' ')) THEN an ELSE bn END AS left_docs,
        CASE WHEN sha256(array_to_string(lset, ' ')) < sha256(array_to_string(rset, ' ')) THEN bn ELSE an END AS right_docs,
        least(ad, bd) AS doc_a, greatest(ad, bd) AS doc_b FROM tp WHERE sim >= 0.8
        UNION ALL SELECT 1.0::DOUBLE, docs, docs, doc, doc FROM tg WHERE docs > 1""", SETS,
    ),
    "duplicate_groups": with_corpus(
        f"""SELECT reason, group_key, count(*) AS members,
        array_to_string((list(concat(space_key, ':', page_id) ORDER BY space_key, page_id))[1:10], ', ') AS documents
        FROM (SELECT 'content_hash' AS reason, source_content_hash AS group_key, space_key, page_id FROM idx
        UNION ALL SELECT 'normalized_title', {NORM.format(c='title')}, space_key, page_id FROM idx) WHERE group_key <> ''
        GROUP BY reason, group_key HAVING count(*) > 1""", index_sql(),
    ),
    "title_families": with_corpus("SELECT family_id, document_id, members FROM fam", SETS, FAMS).replace("WITH ", "WITH RECURSIVE ", 1),
    "family_metadata": with_corpus("SELECT * FROM fmeta", index_sql(), SETS, FAMS, _meta("fam", "family_id")).replace("WITH ", "WITH RECURSIVE ", 1),
    "duplicate_keeper": with_corpus(
        "SELECT group_key, members, keeper FROM mk JOIN ml USING (group_key) WHERE members > 1", index_sql(), _TITLE_GROUPS, _choice("tgm", "group_key")
    ),
    "latest_member": with_corpus(
        "SELECT group_key, latest FROM ml WHERE members > 1", index_sql(), _TITLE_GROUPS, _choice("tgm", "group_key")
    ),
    "latest_production_member": with_corpus(
        "SELECT group_key, latest_production FROM ml LEFT JOIN mp USING (group_key) WHERE members > 1", index_sql(), _TITLE_GROUPS,
        _choice("tgm", "group_key"),
    ),
    "duplicate_clusters": with_corpus(
        f"""SELECT reason, group_key, coalesce(nullif({_LABEL}, ''), first_title) AS family,
        CASE WHEN reason = 'near_title_family' THEN family_type ELSE reason END AS family_type, versions, environments, regions,
        members, keeper, latest, coalesce(latest_production, '-') AS latest_production, array_to_string(ks[1:20], ', ') AS documents
        FROM gone JOIN fmeta USING (reason, group_key, part) JOIN mk USING (reason, group_key, part) JOIN ml USING (reason, group_key, part)
        LEFT JOIN mp USING (reason, group_key, part)""",
        index_sql(), SETS, FAMS, CLUSTER, _meta("gmem", "reason, group_key, part"), _choice("gmem", "reason, group_key, part"),
    ).replace("WITH ", "WITH RECURSIVE ", 1),
}
