"""Place of a page in its tree: counts from a self join, context and role from the path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx
from corpuswright.session import salted_join

ROOT = "__root__"


def parent_id(ancestors: Column) -> Column:
    """Id of the last ancestor (``None`` without one or when it has no id)."""
    return F.when(F.size(ancestors) > 0, F.nullif(F.element_at(ancestors, -1)["id"], F.lit("")))


def ancestor_titles(ancestors: Column) -> Column:
    return F.transform(ancestors, lambda a: a["title"])


def hierarchy_counts(pages: DataFrame, *, hot_rows: int = 1_000_000) -> DataFrame:
    """(document_id, child_count, sibling_count) within the given pages.

    Children count for a parent that is itself in the set; siblings share a parent id (pages
    without one share the root) and exclude the page. Only ids travel; the counts per parent are
    combined on the map side, and a parent with very many children is joined back in pieces.
    """
    ids = pages.select(
        "document_id", "page_id", F.coalesce(parent_id(F.col("ancestors")), F.lit(ROOT)).alias("parent")
    )
    groups = ids.groupBy("parent").agg(F.count(F.lit(1)).alias("group_size"))
    children = groups.where(F.col("parent") != ROOT).select(
        F.col("parent").alias("page_id"), F.col("group_size").alias("child_count")
    )
    with_siblings = salted_join(ids, groups, "parent", by=["document_id"], hot_rows=hot_rows)
    return with_siblings.join(children, "page_id", "left").select(
        "document_id",
        F.coalesce("child_count", F.lit(0)).alias("child_count"),
        F.greatest(F.col("group_size") - 1, F.lit(0)).alias("sibling_count"),
    )


def context_type(title: Column, terms=fv.CONTEXT_TERMS) -> Column:
    """First context whose words occur in the title."""
    lowered = F.lower(title)
    chain = F.lit(None).cast("string")
    for name, words in reversed(list(terms.items())):
        chain = F.when(tx.contains_any(lowered, words), F.lit(name)).otherwise(chain)
    return F.when(title != "", chain)


def hierarchy_context(pages: DataFrame, counts: DataFrame) -> DataFrame:
    """Add the hierarchy columns to ``pages`` (one join on the document id)."""
    titled = pages.join(counts, "document_id", "left").withColumns(
        {
            "child_count": F.coalesce("child_count", F.lit(0)),
            "sibling_count": F.coalesce("sibling_count", F.lit(0)),
            "ancestor_titles": ancestor_titles(F.col("ancestors")),
        }
    )
    placed = titled.withColumns(
        {
            "depth": F.size("ancestor_titles"),
            "parent_title": F.when(F.size("ancestor_titles") > 0, F.element_at("ancestor_titles", -1)),
        }
    ).withColumns(
        {
            "root_title": F.when(F.col("depth") > 0, F.element_at("ancestor_titles", 1)).otherwise(
                F.col("title")
            ),
            "section_path": F.array_join(
                F.filter(F.concat("ancestor_titles", F.array("title")), lambda t: t != ""), " > "
            ),
            "parent_context_type": context_type(F.col("parent_title")),
            "ancestor_context_types": F.array_sort(
                F.array_distinct(
                    F.array_compact(F.transform("ancestor_titles", lambda t: context_type(t)))
                )
            ),
        }
    )
    role = page_role()
    return placed.withColumn("page_role", role).withColumns(
        {
            "is_root_page": F.col("depth") == 0,
            "is_index_page": F.col("page_role").isin("index_page", "runbook_index"),
            "is_leaf_page": F.col("child_count") == 0,
        }
    )


def page_role() -> Column:
    """Role from title, children and context; the first rule that holds decides."""
    title = F.lower("title")
    has_children = F.col("child_count") > 0
    under_runbook = (F.col("parent_context_type") == "runbook") | F.array_contains(
        "ancestor_context_types", "runbook"
    )
    under_reference = F.col("parent_context_type").isin("architecture", "business", "reference")
    return (
        F.when(has_children & tx.contains_any(title, ["index", "summary", "overview"]), "index_page")
        .when(has_children & (context_type(F.col("title")) == "runbook"), "runbook_index")
        .when(tx.contains_any(title, ["rollback", "failover", "procedure"]), "procedure_page")
        .when(tx.contains_any(title, ["release", "change"]), "release_note")
        .when(tx.contains_any(title, fv.CONTEXT_TERMS["performance"]), "test_report")
        .when(F.coalesce(under_runbook, F.lit(False)), "runbook_detail")
        .when(F.coalesce(under_reference, F.lit(False)), "reference_detail")
        .when(has_children, "index_page")
        .otherwise("leaf_page")
    )
