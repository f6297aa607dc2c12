"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from corpuswright.llm.block_max import ranked_search
from corpuswright.llm.byte_pairs import round_trip
from corpuswright.llm.chosen_path import similar_texts
from corpuswright.llm.common import table
from corpuswright.llm.fill_middle import fill_in_middle
from corpuswright.llm.language import identify
from corpuswright.llm.mixing import mix_plan
from corpuswright.llm.nn_descent import near_duplicates
from corpuswright.llm.packing import pack
from corpuswright.llm.pii import find_private, span_report
from corpuswright.llm.quality import judge
from corpuswright.llm.toolcalls import TOOLS, derived_messages, link_tool_calls
from corpuswright.llm.toxicity import detect
from corpuswright.llm.warc import archive_round_trip


def op1_tool_call_linking(spark, sf_dir):
    return link_tool_calls(derived_messages(table(spark, sf_dir, "conversations")), TOOLS)


def op2_hash_threshold_mix(spark, sf_dir):
    return mix_plan(table(spark, sf_dir, "documents"))


def op3_disclosure_pii(spark, sf_dir):
    found, _ = find_private(table(spark, sf_dir, "documents"))
    return span_report(found)


def op4_distribution_divergence(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op5_lexical_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


def op6_nn_descent(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_warc_boundary_chain(spark, sf_dir):
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op10_language_spans(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def op8_chosen_path_join(spark, sf_dir):
    return similar_texts(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


def op9_toxic_segments(spark, sf_dir):
    return detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_pair_tree_bpe(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark, sf_dir):
    return fill_in_middle(table(spark, sf_dir, "documents"))


def op13_block_max_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_tool_call_linking": op1_tool_call_linking,
    "op2_hash_threshold_mix": op2_hash_threshold_mix,
    "op3_disclosure_pii": op3_disclosure_pii,
    "op4_distribution_divergence": op4_distribution_divergence,
    "op5_lexical_packing": op5_lexical_packing,
    "op6_nn_descent": op6_nn_descent,
    "op7_warc_boundary_chain": op7_warc_boundary_chain,
    "op8_chosen_path_join": op8_chosen_path_join,
    "op9_toxic_segments": op9_toxic_segments,
    "op10_language_spans": op10_language_spans,
    "op11_pair_tree_bpe": op11_pair_tree_bpe,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_block_max_search": op13_block_max_search,
}

OP2 = r"""
with slim as (
  select doc_id, source, case when source is null then '1' else '0' || source end as src,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 13))::bigint as h
  from documents),
sized as (select src, sum(size)::bigint as source_size from slim group by src),
weighed as (
  select src, source_size, 2 * source_size as cap,
    [3.0, 1.0, 2.0][((row_number() over (order by src) - 1) % 3 + 1)::int]::double as weight,
    (sum(source_size) over ())::double * 1.5 as budget
  from sized),
filling as (
  select *, (sum(cap) over w - cap)::double as filled,
    sum(weight) over (order by cap / weight, src rows between current row and unbounded following) as open
  from weighed window w as (order by cap / weight, src rows between unbounded preceding and current row)),
targets as (
  select src, source_size, greatest(0.0, least(cap::double, weight * max((budget - filled) / open) over ()))::double as target
  from filling),
budgets as (
  select *, (case when source_size > 0 then floor(target / source_size) else 0 end)::bigint as base,
    target - (case when source_size > 0 then floor(target / source_size) else 0 end) * source_size as rest
  from targets),
summed as (select src, h, sum(size) as s from slim group by src, h),
running as (select src, h, s, sum(s) over (partition by src order by h) as reached from summed),
crossing as (
  select r.src, arg_min(h, h) as h, arg_min(s, h) as s, arg_min(reached, h) as reached, any_value(rest) as rest
  from running r join budgets b on r.src = b.src where rest > 0 and reached >= rest group by r.src),
limits as (select src, h + case when reached - rest <= rest - (reached - s) then 1 else 0 end as threshold from crossing)
select doc_id, source, size, source_size, target, base + case when h < coalesce(threshold, 0) then 1 else 0 end as copies,
  size * (base + case when h < coalesce(threshold, 0) then 1 else 0 end) as taken
from slim join budgets using (src) left join limits using (src)
"""

OP4 = r"""
with d as materialized (
  select row_number() over () as r, doc_id, coalesce(text, '') as text, case when lang is null then '' else 'l' || lang end as lang_key,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
w as materialized (select r, lang_key, unnest(words) as word, unnest(range(len(words))) as pos from d),
chars as (
  select r, lang_key, len(words) as n, length(text) as n_chars, regexp_replace(text, '\p{L}+', '', 'g') as rest,
    length(regexp_replace(text, '\P{Lu}+', '', 'g')) as upper from d),
classes as (
  select r, lang_key, n, n_chars, upper, n_chars - length(rest) - upper as lower,
    length(rest) - length(regexp_replace(rest, '[\x20\x09-\x0D]+', '', 'g')) as blanks,
    length(rest) - length(regexp_replace(rest, '[0-9]+', '', 'g')) as digits,
    length(rest) - length(translate(rest, '#*$%&|<>', '')) as symbols, length(rest) as others from chars),
counted as (select r, lang_key, n, n_chars, lower, upper, digits, blanks, symbols, others - blanks - digits - symbols as marks from classes),
keyed as (
  select lang_key as key, n, n_chars, lower, upper, digits, blanks, symbols, marks from counted where lang_key <> ''
  union all select '', n, n_chars, lower, upper, digits, blanks, symbols, marks from counted),
sums as (
  select key, sum(n) as n, greatest(sum(n_chars), 1) as n_chars, [sum(lower), sum(upper), sum(digits), sum(blanks), sum(symbols), sum(marks)] as c
  from keyed group by key having key = '' or sum(n) >= 2000),
own_counts as (select lang_key as key, word, count(*) as n from w group by lang_key, word),
counts as (
  select key, word, n from own_counts where key <> ''
  union all select '', word, sum(n) from own_counts group by word),
ranked as (select key, word, n, row_number() over (partition by key order by n desc, word) as k from counts),
common as (select t.key, t.word, t.n / s.n as q from ranked t join sums s using (key) where k <= 40),
shares as (select key, list_transform(c, lambda x: x / n_chars) as cq, coalesce((select sum(q) from common where common.key = sums.key), 0) as all_q from sums),
used as (select c.*, case when s.key is null then '' else c.lang_key end as key from counted c left join sums s on s.key = c.lang_key),
class_parts as (
  select r, unnest([lower, upper, digits, blanks, symbols, marks]) / greatest(n_chars, 1) as p, unnest(cq) as q from used join shares using (key)),
class_distance as (
  select r, sqrt(greatest(0, sum(case when p > 0 then p * ln(2 * p / (p + q)) else 0 end + case when q > 0 then q * ln(2 * q / (p + q)) else 0 end) / (2 * ln(2)))) as cd
  from class_parts group by r),
occurs as (select u.r, u.key, w.word, count(*) / any_value(u.n) as p from used u join w using (r) group by u.r, u.key, w.word),
seen as (select o.r, o.p, c.q from occurs o join common c on c.key = o.key and c.word = o.word),
seen_sums as (
  select r, sum(p) as sp, sum(q) as sq, sum(p * ln(2 * p / (p + q)) + q * ln(2 * q / (p + q))) as t from seen group by r),
word_parts as (
  select u.r, coalesce(t, 0) + (all_q - coalesce(sq, 0)) * ln(2) as t, 1 - coalesce(sp, 0) as p, 1 - all_q as q
  from used u join shares using (key) left join seen_sums using (r)),
word_distance as (
  select r, sqrt(greatest(0, (t + case when p > 0 then p * ln(2 * p / (p + q)) else 0 end + case when q > 0 then q * ln(2 * q / (p + q)) else 0 end) / (2 * ln(2)))) as wd
  from word_parts),
trigrams as (select r, pos, word || ' ' || lead(word) over o || ' ' || lead(word, 2) over o as g from w window o as (partition by r order by pos)),
again as (select r, pos from trigrams where g is not null qualify count(*) over (partition by r, g) > 1),
covered as (select r, count(distinct place) as n_repeat from (select r, unnest([pos, pos + 1, pos + 2]) as place from again) group by r),
lines as (select r, unnest(string_split(text, chr(10))) as line from d),
dups as (select r, count(*) - count(distinct line) as n_dup from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
verdict as (
  select d.doc_id, u.n, u.n_chars, u.blanks, u.symbols, coalesce(n_dup, 0) as n_dup, coalesce(n_repeat, 0) as n_repeat, cd, wd,
    u.n < 50 or 100 * coalesce(n_repeat, 0) > 50 * u.n as failed
  from d join used u using (r) join class_distance using (r) join word_distance using (r) left join covered using (r) left join dups using (r))
select doc_id, n::bigint as n_words, (n_chars - blanks)::bigint as word_chars, symbols::bigint as n_symbols, n_dup::bigint as n_dup_lines,
  n_repeat::bigint as n_repeat_words, failed as base_failed,
  not failed and not ((n_chars >= 200 and cd > 0.26) or (n >= 100 and wd > 0.42)) as kept
from verdict
"""

OP7 = """
with rows as (
  select page_id, coalesce(html, '') as payload, strlen(coalesce(html, ''))::bigint as payload_bytes,
    sha256(coalesce(html, '')) as payload_digest from pages),
firsts as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as first_id
  from rows)
select page_id, payload_bytes, payload_digest,
  case when page_id is distinct from first_id and first_id is not null then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from first_id then first_id end as refers_to
from firsts
"""

OP12 = """
with d as (
  select doc_id, coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
    sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
hashes as (
  select doc_id, body, units, len(units)::bigint as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
    ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form from hashes),
sections as (
  select doc_id, n, form, body, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle,
    array_to_string(units[b + 1:], '') as suffix from cuts),
outputs as (
  select doc_id, n, form, length(prefix) as prefix_chars, length(middle) as middle_chars,
    case form when 'plain' then body when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
      else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end as output from sections),
places as (
  select *, instr(output, '<P>') as p, instr(output, '<S>') as s, instr(output, '<M>') as m from outputs),
restored as (
  select *, case form when 'plain' then output
    when 'psm' then substr(output, p + 3, s - p - 3) || substr(output, m + 3) || substr(output, s + 3, m - s - 3)
    else substr(output, p + 3, m - p - 3) || substr(output, m + 3) || substr(output, s + 3, p - s - 3) end as back from places)
select doc_id, n, form, case when form <> 'plain' then prefix_chars end::bigint as prefix_chars,
  case when form <> 'plain' then middle_chars end::bigint as middle_chars, sha256(output) as output_sha256, sha256(back) as restored_sha256
from restored
"""

OP13 = r"""
with words as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
docs as (select r, doc_id, terms, len(terms)::bigint as n from words where len(terms) > 0),
corpus as (select count(*)::bigint as docs_all, sum(n)::bigint as terms_all from docs),
postings as (select r, term, count(*)::bigint as tf from (select r, unnest(terms) as term from docs) group by r, term),
weights as (
  select term, floor(1000 * ln((2 * docs_all + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from postings, corpus group by term, docs_all),
asked as (
  select distinct item_id, coalesce(text, '') as q,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term,
    generate_subscripts(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), 1) as place
  from benchmark),
times as (select item_id, q, term, count(*)::bigint as times from asked group by item_id, q, term),
parts as (
  select item_id, q, p.r, times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * d.n * docs_all) // terms_all))) as part
  from times join weights using (term) join postings p using (term) join docs d on d.r = p.r, corpus),
scores as (select item_id, q, r, sum(part)::bigint as score from parts group by item_id, q, r having sum(part) > 0),
ranked as (
  select item_id, doc_id, score, row_number() over (partition by item_id, q order by score desc, doc_id asc nulls last, r) as rank
  from scores join docs using (r))
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

SQL = {
    "op2_hash_threshold_mix": OP2,
    "op4_distribution_divergence": OP4,
    "op7_warc_boundary_chain": OP7,
    "op12_fill_in_middle": OP12,
    "op13_block_max_search": OP13,
}
