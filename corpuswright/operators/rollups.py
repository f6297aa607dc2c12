"""Corpus-wide index tables.

A popular theme may be on a third of all documents, so document lists are never gathered into one
row: the roll-up has one row per term with its count, and the membership is a long table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx
from corpuswright.operators.extract import normalize_entity_type

ORDER = ["space_key", "page_id"]


def term_members(docs: DataFrame, column: str) -> DataFrame:
    """(term, document_id, display, place): one row per document and normalised term."""
    listed = docs.select(
        "document_id", *ORDER, F.posexplode(column).alias("pos", "display")
    ).withColumn("term", tx.normalize_term(F.col("display")))
    # a document's terms sit in one task, so this groups without moving much
    return (
        listed.where(F.col("term") != "")
        .groupBy("term", "document_id")
        .agg(F.min(F.struct(*ORDER, "pos", "display")).alias("first"))
        .select("term", "document_id", "first")
    )


def term_rows(
    grouped: DataFrame, *, kind: str, confidence: float, min_documents: int = 3, kept=None
) -> DataFrame:
    """One row per term of (term, document_count, first): id, first display form, document count.

    Single words on fewer than ``min_documents`` documents are dropped unless listed in ``kept``.
    """
    kept = fv.SINGLE_WORDS_KEPT if kept is None else kept
    common = F.col("term").contains(" ") | F.col("term").isin(list(kept)) | (
        F.col("document_count") >= min_documents
    )
    return grouped.where(common).select(
        F.concat(F.lit(f"{kind}:"), tx.slugify(F.col("term"), 120)).alias(f"{kind}_id"),
        F.col("first.display").alias(kind),
        F.col("term").alias(f"normalized_{kind}"),
        "document_count",
        F.lit(confidence).alias("confidence"),
        F.lit("deterministic").alias("method"),
    )


def _counted(docs: DataFrame, column: str) -> DataFrame:
    return term_members(docs, column).groupBy("term").agg(
        F.count(F.lit(1)).alias("document_count"), F.min("first").alias("first")
    )


def theme_rows(grouped: DataFrame, **options) -> DataFrame:
    return term_rows(grouped, kind="theme", confidence=0.65, **options)


def concept_rows(grouped: DataFrame, **options) -> DataFrame:
    rows = term_rows(grouped, kind="concept", confidence=0.58, **options)
    return rows.withColumn(
        "description",
        F.concat(F.lit("Deterministic concept extracted from headings or keywords: "), F.col("concept")),
    )


def theme_rollup(docs: DataFrame, **options) -> DataFrame:
    return theme_rows(_counted(docs, "themes"), **options)


def concept_rollup(docs: DataFrame, **options) -> DataFrame:
    return concept_rows(_counted(docs, "concepts"), **options)


def entity_rollup(entities: DataFrame, docs: DataFrame, *, mentions: int = 100, aliases: int = 100) -> DataFrame:
    """One row per (type, normalised name) with distinct documents, mean confidence, first name.

    The row shows samples: the first ``mentions`` in (document, field, evidence) order, with ``mention_count`` of all, and
    the first ``aliases`` names by alphabet, with ``alias_count`` of all. The rank limits are applied in every map
    task first, so a frequent entity does not reach one task whole; ``entity_mentions`` has every mention as a row.
    """
    keys = ["entity_type", "normalized_name"]
    placed = entities.withColumn(
        "entity_type", normalize_entity_type(F.col("entity_type"), F.col("name"))
    ).join(docs.select("document_id", *ORDER), "document_id")
    per_doc = placed.groupBy(*keys, "document_id").agg(
        # exact sums: a mean on the rounding edge must not depend on the order of addition
        F.sum(F.col("confidence").cast("decimal(18,9)")).alias("c"), F.count(F.lit(1)).alias("n"),
        F.min(F.struct(*ORDER, "rank", "name", "method")).alias("first"),
    )
    groups = per_doc.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("document_count"),
        F.bround(F.sum("c") / F.sum("n"), 2).cast("double").alias("confidence"),
        F.min("first").alias("first"),
    )
    rows = placed.select(*keys, "document_id", F.explode("mentions").alias("m")).select(
        *keys, "document_id", F.col("m.source_field").alias("source_field"), F.col("m.evidence").alias("evidence")
    )
    order = Window.partitionBy(*keys).orderBy("document_id", "source_field", "evidence")
    head = (
        rows.withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= mentions)
        .groupBy(*keys)
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rn", "document_id", "source_field", "evidence"))),
                lambda m: F.struct(m["document_id"], m["source_field"], m["evidence"]),
            ).alias("mentions")
        )
    )
    said = entities if "aliases" in entities.columns else entities.withColumn("aliases", F.array().cast("array<string>"))
    typed = said.withColumn("entity_type", normalize_entity_type(F.col("entity_type"), F.col("name")))
    also = typed.select(*keys, F.explode("aliases").alias("alias")).select(*keys, tx.strip(F.col("alias")).alias("alias"))
    also = also.where("alias <> ''").distinct()
    counted = also.groupBy(*keys).agg(F.count(F.lit(1)).alias("alias_count"))
    by_name = Window.partitionBy(*keys).orderBy("alias")
    known = also.withColumn("rn", F.row_number().over(by_name)).where(F.col("rn") <= aliases)
    known = known.groupBy(*keys).agg(F.array_sort(F.collect_list("alias")).alias("aliases"))
    total = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("mention_count"))
    full = groups.join(head, keys, "left").join(total, keys, "left").join(known, keys, "left").join(counted, keys, "left")
    return full.select(
        F.concat(F.lit("candidate:"), "entity_type", F.lit(":"), tx.slugify(F.col("normalized_name"), 120)).alias("entity_id"),
        F.col("first.name").alias("name"), "normalized_name", "entity_type", "document_count", "confidence",
        F.col("first.method").alias("method"), "mentions", F.coalesce("mention_count", F.lit(0)).alias("mention_count"),
        tx.coalesce_array(F.col("aliases")).alias("aliases"), F.coalesce("alias_count", F.lit(0)).alias("alias_count"),
    )


def entity_mentions(entities: DataFrame) -> DataFrame:
    """(entity_type, normalized_name, document_id, source_field, evidence): every mention of every entity."""
    typed = entities.withColumn("entity_type", normalize_entity_type(F.col("entity_type"), F.col("name")))
    return typed.select("entity_type", "normalized_name", "document_id", F.explode("mentions").alias("m")).select(
        "entity_type", "normalized_name", "document_id", "m.source_field", "m.evidence"
    )


def fact_rows(facts: DataFrame, docs: DataFrame) -> DataFrame:
    """Facts with their document keys and an id ending in the 1-based ordinal."""
    return facts.join(
        docs.select("document_id", *ORDER, "source_content_hash"), "document_id"
    ).withColumn(
        "fact_id", F.concat(F.lit("fact:"), F.concat_ws(":", "space_key", "page_id", "ordinal"))
    )


def fact_trust_split(facts: DataFrame, *, threshold: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(trusted facts, evidence hints)."""
    return facts.where(F.col("confidence") >= threshold), facts.where(F.col("confidence") < threshold)


def all_facts(trusted: DataFrame, hints: DataFrame) -> DataFrame:
    return trusted.unionByName(hints)


INDEX_COLUMNS = [
    "document_id", "page_id", "space_key", "title", "url", "source_updated_at", "source_content_hash",
    "document_type", "document_type_confidence", "document_subtype", "content_availability",
    "quality_band", "status_flags", "review_flags", "audience", "sensitivity", "labels",
    "ancestor_titles", "outbound_link_count", "attachment_count", "word_count", "heading_count",
    "text_simhash", "heading_simhash", "hierarchy_depth", "parent_title", "root_title", "section_path",
    "page_role", "parent_context_type", "sibling_count", "child_count",
]


def document_index_rows(enriched: DataFrame, signatures: DataFrame) -> DataFrame:
    """The flat index row of every enriched page (one join for the signatures)."""
    named = enriched.withColumnsRenamed(
        {"updated_at": "source_updated_at", "link_count": "outbound_link_count", "depth": "hierarchy_depth"}
    )
    return named.join(signatures.drop("heading_count"), "document_id", "left").select(*INDEX_COLUMNS)


def quality_rows(enriched: DataFrame) -> DataFrame:
    q = F.col("quality")
    return enriched.select(
        "document_id", "page_id", "space_key", "source_content_hash",
        q["overall_score"].alias("quality_score"), "quality_band",
        F.create_map(
            F.lit("freshness"), q["freshness_score"],
            F.lit("authority"), q["authority_score"],
            F.lit("completeness"), q["completeness_score"],
            F.lit("operational_value"), q["operational_value_score"],
            F.lit("ownership_clarity"), q["ownership_clarity_score"],
            F.lit("contradiction_penalty"), q["contradiction_risk_score"],
        ).alias("dimensions"),
        "warnings",
    )


def stable_order(df: DataFrame, *extra: str) -> DataFrame:
    """Rows in (space, page) text order."""
    return df.orderBy(*ORDER, *extra)


def title_token_ops(left: Column, right: Column) -> tuple[Column, Column]:
    """(shared, all) normalised words of two titles."""
    def words(c: Column) -> Column:
        return tx.unique_filtered(F.split(tx.normalize_term(c), " "))

    return F.array_intersect(words(left), words(right)), F.array_union(words(left), words(right))
