"""The enrichment job: pages in, enriched pages plus entity and fact tables out.

Everything read from the text happens first, in the scan stage, and its slim result (no text, no
Markdown) is written to the shared checkpoint folder. Joins, roll-ups, reports and exports start
from there: the texts are not scanned again, and a filter on a derived flag stays a filter on a
column instead of being pushed down as the whole rule set.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.functions import text as tx
from corpuswright.operators import classify as cl
from corpuswright.operators import extract as ex
from corpuswright.operators import flags as fl
from corpuswright.operators import hierarchy as hi
from corpuswright.operators import profile as pr
from corpuswright.operators import score as sc
from corpuswright.session import cut_lineage

HEAVY = ["text", "markdown", "links"]


@dataclass(frozen=True)
class Enriched:
    pages: DataFrame
    entities: DataFrame
    facts: DataFrame


def page_features(pages: DataFrame, as_of, *, inside_domains=(), person_id: str | None = None) -> DataFrame:
    """All columns one row yields on its own; ``pages`` needs the columns of ``schemas.PAGES``."""
    df = pr.content_availability(pr.text_stats(fl.attachment_gap(pages)))
    df = cl.document_subtypes(cl.classify_documents(df))
    df = cl.operational_signals(cl.status_flags(df, as_of))
    # an empty page counts as reference from here on (its flags are judged before)
    df = df.withColumn(
        "document_type",
        F.when(
            (F.col("content_availability") == "empty") & (F.col("document_type") != "archive"), "reference"
        ).otherwise(F.col("document_type")),
    )
    historical, state = cl.currentness(df, as_of)
    df = df.withColumns({"historical": historical, "currentness": state})
    df = ex.opening_text(sc.procedure_features(sc.quality_scores(df, as_of)))
    df = fl.trust_flags(fl.sensitivity_flags(df, inside_domains=inside_domains, person_id=person_id), as_of)
    return fl.review_flags_union(fl.usability_flags(fl.missing_content_flags(df)))


def _with_visual_columns(pages: DataFrame) -> DataFrame:
    missing = {
        name: F.lit(None).cast(kind)
        for name, kind in (("visual_status", "string"), ("images_succeeded", "int"))
        if name not in pages.columns
    }
    return pages.withColumns(missing) if missing else pages


def _keyworded(pages: DataFrame, terms: DataFrame) -> DataFrame:
    return pages.join(terms, "document_id", "left").withColumn("keywords", tx.coalesce_array(F.col("keywords")))


def own_features(pages: DataFrame, as_of, *, inside_domains=(), person_id: str | None = None) -> DataFrame:
    """Everything a page yields whatever its neighbours are: the slim columns of its text, and its keywords."""
    pages = _with_visual_columns(pages)
    slim = page_features(pages, as_of, inside_domains=inside_domains, person_id=person_id).drop(*HEAVY)
    return _keyworded(cut_lineage(slim), cut_lineage(ex.keywords(pages)))


def finished_pages(features: DataFrame, counts: DataFrame) -> DataFrame:
    """Pages from their own features and their place in the tree (``hierarchy_counts``); no text is read."""
    df = sc.quality_warnings(sc.quality_adjust(hi.hierarchy_context(features, counts)))
    df = ex.summaries(ex.concepts(ex.themes(ex.categories(df))))
    return df.withColumns(
        {
            "warnings": F.array_union("warnings", "review_flags"),
            "confidence": sc.page_confidence(),
        }
    )


def enrich(pages: DataFrame, as_of, *, inside_domains=(), person_id: str | None = None, with_facts: bool = True) -> Enriched:
    pages = _with_visual_columns(pages)
    slim = cut_lineage(page_features(pages, as_of, inside_domains=inside_domains, person_id=person_id).drop(*HEAVY))
    terms = cut_lineage(ex.keywords(pages))
    df = cut_lineage(finished_pages(_keyworded(slim, terms), hi.hierarchy_counts(pages)))
    named = _keyworded(pages.select("document_id", "page_id", "title", "labels", "links"), terms)
    entities = cut_lineage(ex.candidate_entities(named))
    facts = ex.candidate_facts(pages, entities) if with_facts else None
    return Enriched(df, entities, facts)
