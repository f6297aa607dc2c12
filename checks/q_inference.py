"""Model-inference batch."""

from __future__ import annotations

import pandas as pd
from checks.corpus import AS_OF, documents, index_rows, index_sql, table, with_corpus
from checks.q_classify import J, q
from checks.q_extract import NORM, strings
from checks.q_reports import enriched_rule, rates
from corpuswright import fixed_values as fv
from corpuswright.operators import inference as nf
from pyspark.sql import functions as F

ITEMS = nf.plan_tasks(
    ["keywords", "themes", "summary", "classification"], provider="b", model="m2", prompt_version="v9",
    bundles={"semantic": {"tasks": ["themes", "keywords", "concepts"], "model": "m1"}}, routes={"summary": {"provider": "a", "model": "m1"}},
)
TEMPLATES = {"semantic-v1": "Do {task} as {contract} of {metadata_json}: {chunk} {{end}}"}
CONTRACTS = {"themes": '{"themes":["t"]}', "keywords": '{"keywords":["k"]}', "key_facts": '{"key_facts":[]}', "summary": '{"short_summary":"s"}'}
ITEM_ROWS = [("bundle:semantic", "semantic", "b", "m1", "semantic-v1"), ("classification", "classification", "b", "m2", "v9"), ("summary", "summary", "a", "m1", "v9")]


def chunks(spark, sf):
    return nf.chunk_documents(documents(spark, sf), max_tokens=500, overlap_tokens=50)


def prompts(spark, sf):
    """Prompts over conversations: every turn is a document of its own."""
    turns = table(spark, sf, "conversations").select(
        F.concat(F.lit("doc:"), "conv_id", F.lit(":"), "turn").alias("document_id"), "text", "role",
        F.sha2("text", 256).alias("source_content_hash"), F.lit("cfg").alias("config_hash"),
    )
    cut = nf.chunk_documents(turns, max_tokens=250, overlap_tokens=25)
    rows = cut.join(turns.drop("text"), "document_id")
    return nf.build_prompts(
        nf.with_work_items(rows, ITEMS), ITEMS, metadata=["document_id", "role", "chunk_index", "chunk_count"], templates=TEMPLATES, contracts=CONTRACTS
    )


def cached(spark, sf):
    """Answers of an earlier run for every third turn; some are no JSON, some broken beyond repair, some of unknown keys."""
    keyed = nf.response_cache_key(prompts(spark, sf)).where("cast(split(document_id, ':')[2] as int) % 3 = 0")
    return keyed.groupBy("cache_key").agg(
        F.max(F.expr(
            "case cast(split(document_id, ':')[1] as int) % 5 when 0 then 'sorry' when 1 then '{oops not json at all }}' when 2 then '{\"bogus_key\": 1}' "
            "else case item_no when 0 then '{\"keywords\": [\"old\"]}' when 1 then '{\"document_type\": \"runbook\", \"confidence\": 0.5}' "
            "else '{\"short_summary\": \"a\", \"detailed_summary\": \"b\"}' end end"
        )).alias("text"),
        F.lit("m0").alias("answer_model"), F.lit(7).cast("bigint").alias("input_tokens"), F.lit(1).cast("bigint").alias("output_tokens"),
    )


def answer(batch: pd.DataFrame) -> pd.DataFrame:
    """Stand-in model: tells the length of the prompt; some prompts are refused, some make the whole call raise."""
    size = batch["prompt"].str.len()
    if (size % 29 == 0).any():
        raise ValueError("a prompt this model does not take")
    refused = size % 17 == 0
    return pd.DataFrame(
        {
            "cache_key": batch["cache_key"], "text": ('{"keywords": ["k' + size.astype(str) + '"]}').where(~refused, None),
            "answer_model": batch["model"], "input_tokens": size, "output_tokens": 5,
            "attempts": size % 3 + 1, "retries": size % 3, "elapsed_ms": size * 2,
            "error_type": pd.Series("refused", index=batch.index).where(refused, None),
        }
    )


def asked(spark, sf):
    hits, todo, _ = nf.response_cache_join(prompts(spark, sf), cached(spark, sf))
    return nf.responses(hits, todo, nf.infer_batch(todo, answer))


def notes(spark, sf):
    """Warning and failure rows of one batch over texts cut to two chunks."""
    turns = table(spark, sf, "conversations").select(
        F.concat(F.lit("doc:"), "conv_id", F.lit(":"), "turn").alias("document_id"), "text", "role",
        F.sha2("text", 256).alias("source_content_hash"), F.lit("cfg").alias("config_hash"),
    )
    cut = nf.chunk_documents(turns, max_tokens=250, overlap_tokens=225, max_chunks=2)
    rows = nf.with_work_items(cut.join(turns.drop("text"), "document_id"), ITEMS)
    ready = nf.build_prompts(rows, ITEMS, metadata=["document_id", "role", "chunk_index", "chunk_count"], templates=TEMPLATES, contracts=CONTRACTS)
    split = nf.response_cache_join(ready, cached(spark, sf))
    answers = nf.responses(split.hits, split.todo, nf.infer_batch(split.todo, answer))
    told = nf.inference_warnings(nf.response_cache_key(ready), split.refreshed).withColumnRenamed("warning", "kind")
    failed = nf.inference_failures(nf.validate_responses(nf.parse_responses(answers)))
    return told.unionByName(failed.select("document_id", "task", "chunk_index", F.col("stage").alias("kind"), F.col("reason").alias("detail")))


N = "(event_id % 12)"


def raw_answers(spark, sf):
    """Answer texts of many shapes, one per event."""
    k = "concat('w', user_id)"
    texts = {
        0: f"concat('{{\"keywords\": [\"', {k}, '\"]}}')",
        1: f"concat('```json\\n{{\"keywords\": [\"', {k}, '\"]}}\\n```')",
        2: f"concat('Here: {{\"keywords\": [\"', {k}, '\",]}} done')",
        3: f"concat('{{\"keywords\": [\"', {k}, '\"')",
        4: f"concat('{{\"keywords\": [\"', {k}, '\\n\"]}}')",
        5: "'no json'",
        6: f"concat('[\"', {k}, '\"]')",
        7: f"concat('{{\"keywords\": \"', {k}, '\"}}')",
        8: f"concat('{{\"keywords\": [\"', {k}, '\"], \"extra\": 1}}')",
        9: "concat('{\"keywords\": [', repeat('\"a\",', 60), '\"b\"]}')",
        10: "'{}'",
        11: f"concat('{{\"keywords\": null}}')",
    }
    whens = " ".join(f"when {n} then {t}" for n, t in texts.items())
    return table(spark, sf, "events").selectExpr(
        "event_id", "concat('doc:', user_id) document_id", "array('keywords') requested_tasks", f"case {N} {whens} end text"
    )


def typed_answers(spark, sf):
    """Classification answers: known, aliased and unknown types, good and bad confidences."""
    kinds = "element_at(array('runbook', 'How-To', 'release notes', 'poem', 'ADR', 'archive'), cast(event_id % 6 as int) + 1)"
    return table(spark, sf, "events").selectExpr(
        "event_id", "concat('doc:', user_id) document_id", "array('classification') requested_tasks",
        f"concat('{{\"document_type\": \"', {kinds}, '\", \"confidence\": ', event_id % 14, ' }}') text0", "event_id % 7 c",
    ).withColumn(
        "text",
        F.expr("case when c = 0 then replace(text0, ', \"confidence\"', ', \"conf\"') else regexp_replace(text0, '\"confidence\": (\\\\d+)', '\"confidence\": 0.$1') end"),
    ).drop("text0", "c")


def validated(spark, sf):
    rows = raw_answers(spark, sf).unionByName(typed_answers(spark, sf))
    return nf.validate_responses(nf.parse_responses(rows))


def merged(spark, sf):
    """Fold the answers of users into the documents of the same number."""
    base = enriched_rule(spark, sf).selectExpr(
        "document_id", "page_id", "title", "n", "document_type", "cast((n % 10) / 10.0 as double) document_type_confidence", "'s0' short_summary", "'d0' detailed_summary",
        "array('Alpha', concat('w', n)) keywords", "array('beta') themes", "array('x') concepts", "array('low_quality_score') warnings",
        "named_struct(" + ", ".join(f"'{s}', n % 2 = 0" for s in fv.SIGNAL_TERMS) + ") signals",
    )
    ev = table(spark, sf, "events")
    body = (
        "case event_type when 'click' then concat('{\"document_type\": \"', element_at(array('rca', 'design', 'faq'), cast(event_id % 3 as int) + 1), '\", \"confidence\": 0.', event_id % 10, '}') "
        "when 'error' then concat('{\"short_summary\": \"The chunk ', event_id, ' says\", \"detailed_summary\": \"Source chunk ', event_id, '\"}') "
        "else concat('{\"keywords\": [\"K ', event_id % 4, '\", \"alpha\"], \"operational_signals\": {\"has_owner\": ', case when event_id % 50 = 0 then 'true' else 'false' end, "
        "'}, \"warnings\": [\"custom ', event_id % 3, '\"], \"key_facts\": [{\"label\": \"Size\", \"value\": \"', event_id % 5, ' of this chunk\"}]}') end"
    )
    tasks = (
        "case event_type when 'click' then array('classification') when 'error' then array('summary') "
        "else array('keywords', 'operational_signals', 'quality_warnings') end"
    )
    answers = ev.selectExpr("user_id", "case event_type when 'click' then 0 when 'error' then 1 else 2 end item_no", "event_id chunk_index", f"{tasks} requested_tasks", f"{body} text")
    answers = nf.validate_responses(nf.parse_responses(answers)).select("user_id", "item_no", "chunk_index", "requested_tasks", "answer", "valid")
    named = answers.join(base.select("n", "document_id"), F.col("user_id") == F.col("n")).drop("n", "user_id")
    return nf.merge_responses(base, named)


def _generated(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        nf.sanitize_generated(
            F.expr("concat(element_at(array('This Wiki chunk', 'the chunk', 'A document chunk', 'supplied chunk', 'provided wiki chunk', 'a chunk'), cast(event_id % 6 as int) + 1), ' of ', event_type, ' and source chunk')"),
            source_name="Wiki",
        ).alias("text"),
    )


def _aliases(spark, sf):
    names = list(fv.DOCUMENT_TYPE_ALIASES) + ["Runbook", "Known Error", "poem"]
    arr = ", ".join(q(n) for n in names)
    rows = table(spark, sf, "events").selectExpr("event_id", f"element_at(array({arr}), cast(event_id % {len(names)} as int) + 1) said")
    return rows.select("event_id", "said", nf.normalize_document_type(F.col("said")).alias("document_type"))


def _usage(spark, sf):
    return nf.usage_rows(asked(spark, sf), rates(spark, sf), run_id="r1").select(
        "document_id", "task", "provider", "model", "input_tokens", "cached", "attempts", "retries", "elapsed_ms", F.round("estimated_cost_usd", 5).alias("cost")
    )


QUERIES = {
    "plan_tasks": lambda s, d: nf.with_work_items(documents(s, d).select("document_id"), ITEMS),
    "chunk_documents": lambda s, d: chunks(s, d).select("document_id", "chunk_index", "chunk_count", F.sha2("chunk", 256).alias("chunk_sha"), "truncated"),
    "chunk_limits": lambda s, d: nf.chunk_documents(documents(s, d), max_tokens=250, overlap_tokens=25, max_chunks=2).where("chunk_index = chunk_count").select(
        "document_id", "chunk_count", "truncated", "chars_left_out"),
    "inference_notes": notes,
    "estimate_tokens": lambda s, d: documents(s, d).select("document_id", nf.estimate_tokens(F.col("text")).alias("tokens")),
    "build_prompts": lambda s, d: prompts(s, d).select("document_id", "task", "chunk_index", F.sha2("prompt", 256).alias("prompt_sha")),
    "response_cache_join": lambda s, d: (lambda p: p[0].select("document_id", "task", "chunk_index", F.lit(True).alias("cached")).unionByName(
        p[1].select("document_id", "task", "chunk_index", F.lit(False).alias("cached"))))(nf.response_cache_join(prompts(s, d), cached(s, d))[:2]),
    "infer_batch": lambda s, d: asked(s, d).select("document_id", "task", "chunk_index", "text", "cached", "error_type", "attempts", "elapsed_ms"),
    "parse_responses": lambda s, d: nf.parse_responses(raw_answers(s, d)).select(
        "event_id", F.get_json_object("answer_json", "$.keywords[0]").alias("first"), F.col("answer_json").isNotNull().alias("readable"), "parse_warnings"
    ),
    "validate_responses": lambda s, d: validated(s, d).select(
        "event_id", F.element_at("requested_tasks", 1).alias("task"), "valid", "invalid_reason", F.array_join("validation_warnings", "|").alias("validation_warnings"),
        F.size(F.coalesce("answer.keywords", F.array())).alias("keywords"), F.col("answer.document_type").alias("document_type"),
    ),
    "merge_responses": lambda s, d: merged(s, d).select(
        "document_id", "document_type", F.round("document_type_confidence", 3).alias("confidence"), "short_summary", "detailed_summary", "keywords", "warnings",
        F.col("signals.has_owner").alias("has_owner"), F.array_join(F.transform("key_facts", lambda f: F.concat_ws("=", f["label"], f["value"])), "|").alias("key_facts"),
    ),
    "sanitize_generated": _generated,
    "normalize_document_type": _aliases,
    "usage_rows": _usage,
}

_FENCE = "chr(10)"

def turns(count: str, step: int, stored: str) -> str:
    """Chunks, prompts and answers of the turns, given how many chunks, their step and which prompts are in the cache."""
    return f"""
tu AS (SELECT concat('doc:', conv_id, ':', turn) AS document_id, conv_id, turn, text, role, length(text) AS len FROM conversations),
tc0 AS (SELECT *, CASE WHEN len <= 1000 THEN 1 ELSE {count} END AS cc FROM tu),
tc AS (SELECT *, i AS ci, substr(text, (i - 1) * {step} + 1, 1000) AS chunk FROM tc0, unnest(range(1, cc + 1)) u(i)),
it AS (SELECT * FROM (VALUES (0, 'bundle:semantic', 'semantic', 'b', 'm1', 'semantic-v1'), (1, 'classification', 'classification', 'b', 'm2', 'v9'),
  (2, 'summary', 'summary', 'a', 'm1', 'v9')) v(item_no, task, pt, provider, model, pv)),
pm0 AS (SELECT tc.*, it.*, concat('{{"chunk_count":', cc, ',"chunk_index":', ci, ',"document_id":"', document_id, '","role":"', role, '"}}') AS meta FROM tc, it),
pm AS (SELECT *, CASE item_no WHEN 0 THEN concat('Do semantic as {{"themes":["t"],"keywords":["k"],"key_facts":[]}} of ', meta, ': ', chunk, ' {{end}}')
  ELSE concat('Your job: ', pt, chr(10), 'Answer with one JSON object of the form ', CASE item_no WHEN 1 THEN '{{}}' ELSE '{{"short_summary":"s"}}' END, chr(10),
  'Say nothing the text does not say; leave out what it does not tell.', chr(10), 'About the document: ', meta, chr(10), chr(10), chunk) END AS prompt FROM pm0),
ca AS (SELECT *, {stored} AS stored, {stored} AND conv_id % 5 > 2 AS hit FROM pm),
an AS (SELECT *, CASE WHEN hit THEN NULL WHEN length(prompt) % 29 = 0 THEN 'ValueError' WHEN length(prompt) % 17 = 0 THEN 'refused' END AS problem,
  CASE item_no WHEN 0 THEN '{{"keywords": ["old"]}}' WHEN 1 THEN '{{"document_type": "runbook", "confidence": 0.5}}' ELSE '{{"short_summary": "a", "detailed_summary": "b"}}' END AS old FROM ca)"""


TURNS = turns("ceil((len - 1000) / 900)::INT + 1", 900, "turn % 3 = 0")
_PARSED = f"""pa AS (SELECT event_id, event_id % 12 AS k, CASE WHEN event_id % 12 IN (0, 1, 2, 3, 8) THEN concat('w', user_id) WHEN event_id % 12 = 4 THEN
  concat('w', user_id, chr(10)) WHEN event_id % 12 = 9 THEN 'a' END AS first, event_id % 12 NOT IN (5, 6) AS readable FROM events)"""
_ALL_ALIASES = list(fv.DOCUMENT_TYPE_ALIASES) + ["Runbook", "Known Error", "poem"]


def _keep(values: str, limit: int) -> str:
    """Order-preserving distinct of a list by normalised value."""
    return (
        f"array_to_string((list_transform(list_filter(range(1, len({values}) + 1), lambda i: list_position(list_transform({values}, lambda v: {NORM.format(c='v')}), "
        f"{NORM.format(c=values + '[i]')}) = i), lambda i: {values}[i]))[1:{limit}], '|')"
    )


MERGE = """
mb AS (SELECT * FROM idx),
ty AS (SELECT user_id AS n, arg_max(t, (c, event_id)) AS t, max(c) AS c FROM (SELECT user_id, event_id, (['rca', 'design', 'knowledge_article'])[event_id % 3 + 1] AS t,
  (event_id % 10) / 10.0::DOUBLE AS c FROM events WHERE event_type = 'click') GROUP BY 1),
su AS (SELECT user_id AS n, max(event_id) AS e FROM events WHERE event_type = 'error' GROUP BY 1),
se AS (SELECT user_id AS n, list(concat('K ', event_id % 4) ORDER BY event_id) AS ks, list(concat('custom ', event_id % 3) ORDER BY event_id) AS ws,
  bool_or(event_id % 50 = 0) AS own, list(concat('Size=', event_id % 5, ' of this document') ORDER BY event_id) AS fs FROM events
  WHERE event_type NOT IN ('click', 'error') GROUP BY 1),
mg AS (SELECT mb.*, ty.t, ty.c, su.e, list_concat(['Alpha', concat('w', mb.n)], coalesce(ks, []::VARCHAR[])) AS kall,
  list_concat(['low_quality_score'], coalesce(ws, []::VARCHAR[])) AS wall, coalesce(fs, []::VARCHAR[]) AS fall, coalesce(own, false) OR mb.n % 2 = 0 AS own
  FROM mb LEFT JOIN ty USING (n) LEFT JOIN su USING (n) LEFT JOIN se USING (n))"""
_FST = "array_to_string(list_filter({a}, lambda x, i: list_position({a}, x) = i), '|')"
RATES = """rt AS (SELECT CASE WHEN s_suppkey < 3 THEN (['a:m1', 'm2', 'b'])[s_suppkey + 1] ELSE concat('other-', s_suppkey) END AS key, round(s_acctbal / 100000, 6) AS ri,
  CASE WHEN s_suppkey = 2 THEN NULL ELSE round(s_acctbal / 50000, 6) END AS ro FROM supplier)"""

SQL = {
    "plan_tasks": with_corpus(
        """SELECT document_id, item_no, task, prompt_task, requested_tasks, provider, model, prompt_version FROM base, (VALUES
        (0, 'bundle:semantic', 'semantic', 'themes|keywords', 'b', 'm1', 'semantic-v1'), (1, 'classification', 'classification', 'classification', 'b', 'm2', 'v9'),
        (2, 'summary', 'summary', 'summary', 'a', 'm1', 'v9')) v(item_no, task, prompt_task, requested_tasks, provider, model, prompt_version)"""
    ),
    "chunk_documents": with_corpus(
        """SELECT document_id, i AS chunk_index, cc AS chunk_count, sha256(substr(text, (i - 1) * 1800 + 1, 2000)) AS chunk_sha,
        false AS truncated FROM
        (SELECT *, CASE WHEN length(text) <= 2000 THEN 1 ELSE ceil((length(text) - 2000) / 1800)::INT + 1 END AS cc FROM base), unnest(range(1, cc + 1)) u(i)"""
    ),
    "chunk_limits": with_corpus(
        """SELECT document_id, least(2, cc) AS chunk_count, cc > 2 AS truncated, CASE WHEN cc > 2 THEN length(text) - 1900 ELSE 0 END AS chars_left_out FROM
        (SELECT *, CASE WHEN length(text) <= 1000 THEN 1 ELSE ceil((length(text) - 1000) / 900)::INT + 1 END AS cc FROM base)"""
    ),
    "inference_notes": f"""WITH {turns("least(2, ceil((len - 1000) / 100)::INT + 1)", 100, "ci = 1 AND len <= 1900 AND turn % 3 = 0")}
        SELECT document_id, task, ci AS chunk_index, 'cached_response_invalid' AS kind, CASE WHEN conv_id % 5 = 2 THEN 'unknown_key' ELSE 'unreadable_json' END AS detail
        FROM an WHERE stored AND NOT hit
        UNION ALL SELECT document_id, task, ci, 'input_left_out', (len - 1100)::VARCHAR FROM an WHERE ci = cc AND cc = 2 AND len > 1100
        UNION ALL SELECT document_id, task, ci, CASE WHEN problem IS NULL THEN 'answer' ELSE 'call' END, coalesce(problem, 'unknown_key') FROM an
        WHERE NOT hit AND (problem IS NOT NULL OR item_no > 0)""",
    "estimate_tokens": with_corpus("SELECT document_id, ceil(length(text) / 4)::BIGINT AS tokens FROM base"),
    "build_prompts": f"WITH {TURNS} SELECT document_id, task, ci AS chunk_index, sha256(prompt) AS prompt_sha FROM pm",
    "response_cache_join": f"WITH {TURNS} SELECT document_id, task, ci AS chunk_index, hit AS cached FROM ca",
    "infer_batch": f"""WITH {TURNS} SELECT document_id, task, ci AS chunk_index, CASE WHEN hit THEN old WHEN problem IS NULL THEN
        concat('{{"keywords": ["k', length(prompt), '"]}}') END AS text, hit AS cached, problem AS error_type,
        CASE WHEN hit THEN 0 WHEN problem = 'ValueError' THEN 1 ELSE length(prompt) % 3 + 1 END::BIGINT AS attempts,
        CASE WHEN NOT hit AND problem IS DISTINCT FROM 'ValueError' THEN length(prompt) * 2 END AS elapsed_ms FROM an""",
    "parse_responses": f"""WITH {_PARSED} SELECT event_id, CASE WHEN k = 7 THEN NULL ELSE first END AS first, readable,
        CASE WHEN k IN (2, 3, 4) THEN 'repaired_json' ELSE '' END AS parse_warnings FROM pa""",
    "validate_responses": """SELECT event_id, 'keywords' AS task, event_id % 12 NOT IN (5, 6, 7, 8) AS valid, CASE event_id % 12 WHEN 5 THEN 'unreadable_json' WHEN 6 THEN
        'unreadable_json' WHEN 7 THEN 'wrong_type' WHEN 8 THEN 'unknown_key' END AS invalid_reason, '' AS
        validation_warnings, CASE WHEN event_id % 12 = 9 THEN 61 WHEN event_id % 12 <= 4 THEN 1 ELSE 0 END AS keywords, NULL AS document_type FROM events
        UNION ALL SELECT event_id, 'classification', event_id % 7 <> 0 AND event_id % 6 <> 3, CASE WHEN event_id % 7 = 0 THEN 'unknown_key' WHEN event_id % 6 = 3 THEN
        'unsupported_document_type' END, '', 0, CASE WHEN event_id % 7 <> 0 THEN (['runbook', 'knowledge_article', 'change_record', NULL, 'design', 'archive'])[event_id % 6 + 1] END
        FROM events""",
    "merge_responses": with_corpus(
        f"""SELECT document_id, CASE WHEN coalesce(c, -1) >= (n % 10) / 10.0::DOUBLE THEN t ELSE document_type END AS document_type,
        round(CASE WHEN coalesce(c, -1) >= (n % 10) / 10.0::DOUBLE THEN c ELSE (n % 10) / 10.0::DOUBLE END, 3) AS confidence,
        CASE WHEN e IS NULL THEN 's0' ELSE concat('the document ', e, ' says') END AS short_summary,
        CASE WHEN e IS NULL THEN 'd0' ELSE concat('source excerpt ', e) END AS detailed_summary, {_FST.format(a='kall')} AS keywords,
        {_FST.format(a='wall')} AS warnings, own AS has_owner, {_FST.format(a='fall')} AS key_facts FROM mg""", index_sql(), MERGE,
    ),
    "sanitize_generated": """SELECT event_id, concat((['this Wiki source excerpt', 'the document', 'A document', 'supplied source excerpt', 'provided Wiki source excerpt',
        'a chunk'])[event_id % 6 + 1], ' of ', event_type, ' and source excerpt') AS text FROM events""",
    "normalize_document_type": f"""SELECT event_id, ({strings(_ALL_ALIASES)})[event_id % {len(_ALL_ALIASES)} + 1] AS said,
        ({strings(list(fv.DOCUMENT_TYPE_ALIASES.values()) + ['runbook', 'known_error', 'poem'])})[event_id % {len(_ALL_ALIASES)} + 1] AS document_type FROM events""",
    "usage_rows": f"""WITH {TURNS}, {RATES}, us AS (SELECT document_id, task, provider, CASE WHEN hit THEN 'm0' ELSE model END AS model,
        CASE WHEN hit THEN 7 ELSE length(prompt) END AS input_tokens, CASE WHEN hit THEN 1 ELSE 5 END AS outt, hit AS cached,
        CASE WHEN hit THEN 0 ELSE length(prompt) % 3 + 1 END AS attempts, CASE WHEN hit THEN 0 ELSE length(prompt) % 3 END AS retries, CASE WHEN NOT hit THEN length(prompt) * 2 END AS elapsed_ms
        FROM an WHERE problem IS NULL)
        SELECT document_id, task, provider, model, input_tokens, cached, attempts, retries, elapsed_ms, round(input_tokens / 1000 * CASE WHEN a.key IS NOT NULL THEN a.ri WHEN b.key IS NOT NULL
        THEN b.ri ELSE c.ri END + outt / 1000 * CASE WHEN a.key IS NOT NULL THEN a.ro WHEN b.key IS NOT NULL THEN b.ro ELSE c.ro END, 5) AS cost FROM us
        LEFT JOIN rt a ON a.key = concat(provider, ':', model) LEFT JOIN rt b ON b.key = model LEFT JOIN rt c ON c.key = provider""",
}
