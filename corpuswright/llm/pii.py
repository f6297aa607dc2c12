"""Personal data: pattern spans, and words that give a protected value away by co-occurring with it.

Patterns find emails, IP addresses, card and phone numbers with their places in the text. Each value found is a
protected entity. The documents that hold it are its contexts. With p the share of documents, a
word t tells about an entity e as much as PMI(e; t) = log p(e, t) / (p(e) p(t)), of the information IC(e) = -log p(e)
there is. Words of any length that tell more than ``max_disclosure`` of it, in several different contexts, are
disclosive: wherever they stand, in any document, they become spans as well and are replaced by [NAME] or [WORD]. All of it is DataFrame functions; texts are never shuffled.

Defined results: null text is an empty text; documents that are equal count as documents but their equal
contexts count once; a null id is kept; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import fresh, let
from corpuswright.session import broadcast_if_small, cut_lineage, release

KINDS = ["email", "ip", "card", "phone"]  # in this order where two spans start together
TERM = "term"
# Possessive runs and look-behinds keep the scans linear; the leftmost matches are those of the plain patterns:
# email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, ip [0-9]+(\.[0-9]+){3}, card [0-9]([ -]?[0-9])+ of 14 to 19
# digits, phone \+[0-9][ ().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?>(?:\.[A-Za-z0-9-]++){1,400})+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
MARK, OTHER = "\u0001", "\u0002"  # neither is part of any pattern, so a mark in a text can stand as the other
CHUNK = 256
WORD = r"[\p{L}\p{N}]+"
SPAN = "struct<start:int,rank:int,end:int,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    places = F.sequence(F.lit(1), n)

    def worth(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _places(p: Column, rank: int, accept) -> Column:
    """Spans of the odd pieces that ``accept`` takes; lengths summed up give the places.

    Pieces are summed in chunks of ``CHUNK``, so the copying stays small for texts with very many matches.
    """
    empty = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(x)
        span = F.struct(acc["at"].alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x.alias("value"))
        hit = acc["odd"] & accept(x)
        return F.struct(end.alias("at"), (~acc["odd"]).alias("odd"), F.when(hit, F.array_append(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    def chunk(acc: Column, c: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), acc["odd"].alias("odd"), empty.alias("found"))
        inner = F.aggregate(F.slice(p, c * CHUNK + 1, F.lit(CHUNK)), start, step)
        return let(inner, lambda s: F.struct(s["at"].alias("at"), s["odd"].alias("odd"), F.concat(acc["found"], s["found"]).alias("found")))

    begin = F.struct(F.lit(0).alias("at"), F.lit(False).alias("odd"), empty.alias("found"))
    return F.aggregate(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / CHUNK).cast("int")), begin, chunk)["found"]


def _matches(kind: str, text: Column) -> Column:
    """Valid spans of one kind. Marks around the matches split the text."""
    rank = KINDS.index(kind)
    parts = F.split(F.regexp_replace(text, PATTERNS[kind], f"{MARK}$0{MARK}"), MARK)
    hint = HINTS[kind]
    likely = text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}") if kind == "card" else F.contains(text, F.lit(hint))
    return F.when(likely, let(parts, lambda p: _places(p, rank, lambda x: _valid(kind, x)))).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """Sorted array of the pattern spans of a text without marks: start, rank of the kind, end, value."""
    return F.sort_array(F.concat(*[_matches(k, text) for k in KINDS]))


def _clean(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), MARK, OTHER)


def _outside(text: Column, spans: Column) -> Column:
    """``text`` with a mark in place of each span."""
    begin = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.array_append(acc["out"], between).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    cut = let(F.aggregate(spans, begin, step), lambda a: F.array_join(F.array_append(a["out"], F.substring(text, a["at"] + 1, F.length(text))), MARK))
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def _terms(text: Column) -> Column:
    """Different words of letters and digits, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def evidence(both: Column, n_term: Column, n_value: Column, total: Column) -> Column:
    """Bound on how unlikely chance is: minus the logarithm of the probability that at least ``both`` of a word's
    ``n_term`` documents hold the value if each does with the value's share of all documents (Chernoff).
    """
    share, usual = both / n_term, n_value / total
    part = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(F.lit(0.0))
    return F.when(share > usual, n_term * (part(share, usual) + part(1 - share, 1 - usual))).otherwise(F.lit(0.0))


def disclosive_terms(found: DataFrame, docs: DataFrame, *, max_disclosure: float = 0.9, min_contexts: int = 3, chance: float = 0.05) -> DataFrame:
    """Cut table (value, term, disclosure) of the words that reveal an entity.

    ``found`` has one row per document with spans: row, text and spans; ``docs`` has text and spans of every document. A
    context is the text of a document outside its spans. Pairs are counted with map-side combine, and only those that can
    disclose: as both <= n_value, a word's documents must be fewer than total ** (1 - limit) * n_value ** limit.
    Documents of a word are counted over the whole corpus, but only for words that co-occur often enough. Of a value in many
    documents a rare word reveals much by luck, so a pair must also be one that chance explains with a probability of at
    most ``chance`` over all words and values that are compared.
    """
    total = float(max(docs.count(), 1))
    outside = found.select("row", F.xxhash64("text").alias("context"), F.array_distinct(F.transform("spans", lambda s: F.lower(s["value"]))).alias("values"), _terms(_outside(F.col("text"), F.col("spans"))).alias("terms"))
    by_doc = cut_lineage(outside)
    values = by_doc.select("row", "context", F.explode("values").alias("value"))
    entities = values.groupBy("value", "context").agg(F.count(F.lit(1)).alias("n")).groupBy("value").agg(F.sum("n").alias("n_value"), F.count(F.lit(1)).alias("contexts"))
    entities = cut_lineage(entities.where(F.col("contexts") >= min_contexts).select("value", "n_value"))
    held = cut_lineage(values.join(entities, "value"))
    terms = by_doc.join(held.select("row").distinct(), "row", "left_semi").select("row", F.explode("terms").alias("term"))
    # documents that hold a word beside any of these entities are some of those that hold it: a bound that spares common words
    most = F.lit(total ** (1 - max_disclosure)) * F.pow(F.col("n_value").cast("double"), F.lit(max_disclosure)) * (1 + 1e-9)
    top = held.agg(F.max(most)).first()[0] or 0.0
    seen = cut_lineage(terms.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).where((F.col("n_term") >= min_contexts) & (F.col("n_term") <= top)))
    pairs = held.join(terms.join(seen, "term"), "row").where(F.col("n_term") <= most)
    together = pairs.groupBy("value", "term", "context", "n_value").agg(F.count(F.lit(1)).alias("n")).groupBy("value", "term", "n_value")
    together = together.agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("contexts")).where(F.col("contexts") >= min_contexts)

    def disclosure() -> Column:
        information = -F.log(F.col("n_value") / F.lit(total))
        pmi = F.log(F.col("both") * F.lit(total) / (F.col("n_value") * F.col("n_term")))
        return F.when(information > 0, pmi / information).otherwise(F.lit(0.0))

    possible = cut_lineage(together.join(seen, "term").where(disclosure() > max_disclosure).drop("n_term"))
    wanted = cut_lineage(possible.select("term").distinct())
    if wanted.isEmpty():
        n_term = wanted.withColumn("n_term", F.lit(0).cast("long"))
    else:
        words = docs.select(F.explode(_terms(_outside(F.col("text"), F.col("spans")))).alias("term"))
        n_term = words.join(broadcast_if_small(wanted, max_rows=200_000), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    rows = possible.join(n_term, "term").withColumn("disclosure", disclosure())
    compared = seen.count() * entities.count()
    proven = evidence(F.col("both"), F.col("n_term"), F.col("n_value"), F.lit(total)) >= F.lit(math.log(max(compared, 1) / chance))
    out = cut_lineage(rows.where((F.col("disclosure") > max_disclosure) & proven).select("value", "term", "disclosure"))
    release(by_doc, entities, held, seen, possible, wanted)
    return out


def _private(rows: DataFrame, text: str, spans: str, key: str, more: str, limits: dict) -> tuple[DataFrame, DataFrame]:
    """``rows`` with clean ``text`` and sorted ``spans``, those of disclosive words among them, and the disclosive pairs.

    Texts are not shuffled for the pattern spans. The words to look for are joined by a digest of the text; up to a
    counted 200,000 texts go to the scan.
    """
    slim = rows.select(F.col(text).alias("text"), F.col(spans).alias("spans"))
    kept = cut_lineage(slim.select(F.monotonically_increasing_id().alias("row"), "spans", "text").where(F.size("spans") > 0))
    terms = disclosive_terms(kept, slim, **limits)
    release(kept)
    if terms.isEmpty():
        return rows, terms
    words = slim.select(F.md5("text").alias(key), F.explode(_terms(_outside(F.col("text"), F.col("spans")))).alias("term"))
    hits = words.join(broadcast_if_small(terms.select("term").distinct(), max_rows=200_000), "term")
    wanted = cut_lineage(hits.groupBy(key).agg(F.collect_set("term").alias(more)))
    out = rows.withColumn(key, F.md5(text)).join(broadcast_if_small(wanted, max_rows=200_000), key, "left")
    both = F.sort_array(F.concat(spans, _term_spans(F.col(text), F.col(spans), F.col(more))))
    return out.withColumn(spans, F.when(F.col(more).isNull(), F.col(spans)).otherwise(both)).drop(key, more), terms


def _term_spans(text: Column, spans: Column, terms: Column) -> Column:
    """Places of ``terms`` in the whole text, outside ``spans``."""
    parts = F.split(F.regexp_replace(text, WORD, f"{MARK}$0{MARK}"), MARK)
    found = let(parts, lambda p: _places(p, len(KINDS), lambda x: F.array_contains(terms, F.lower(x))))
    return F.filter(found, lambda t: ~F.exists(spans, lambda s: (t["start"] < s["end"]) & (t["end"] > s["start"])))


def find_private(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **limits) -> tuple[DataFrame, DataFrame]:
    """Two frames: (row, doc_id, spans) for every document, and the disclosive (value, term) pairs.

    ``spans`` holds pattern spans and, with rank len(KINDS), the disclosive words of the corpus. Runs Spark jobs while the
    plan is built.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), _clean(F.col(text)).alias("text"))
    out, terms = _private(rows.withColumn("spans", base_spans(F.col("text"))), "text", "spans", "key", "more", limits)
    return out.select("row", "doc_id", "spans"), terms


def kind_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in [*KINDS, TERM]]), rank + 1)


def span_report(found: DataFrame) -> DataFrame:
    """doc_id, counts by kind, hash of the pattern spans and all spans as text."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_name(s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    n = lambda i: F.size(F.filter("spans", lambda s: s["rank"] == i)).cast("long")
    return found.select("doc_id", *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def general_form(span: Column) -> Column:
    """What replaces a span: the kind of a pattern span; a disclosive word becomes its general class."""
    word = F.when(span["value"].rlike(r"^\p{Lu}"), F.lit("[NAME]")).otherwise(F.lit("[WORD]"))
    return F.when(span["rank"] < len(KINDS), F.concat(F.lit("["), F.upper(kind_name(span["rank"])), F.lit("]"))).otherwise(word)


def sanitise_text(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced; a span that overlaps an earlier one only lengthens what goes."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        grown = F.when(s["start"] >= acc["at"], F.concat(acc["out"], between, general_form(s))).otherwise(acc["out"])
        return F.struct(grown.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    return let(F.aggregate(spans, begin, step), lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame, *, text: str = "text", **limits) -> DataFrame:
    """``docs`` with every personal span and disclosive word of ``text`` replaced; other columns as they are."""
    spans, clean, key, more = fresh(docs, "_spans", "_clean", "_key", "_more")
    rows = docs.withColumn(clean, _clean(F.col(text))).withColumn(spans, base_spans(F.col(clean)))
    out, _ = _private(rows, clean, spans, key, more, limits)
    replaced = F.when(F.size(spans) > 0, sanitise_text(F.col(clean), F.col(spans))).otherwise(F.col(text))
    return out.select(*[replaced.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
