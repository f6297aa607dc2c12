"""Quality scores, their adjustments and the quality warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx
from corpuswright.functions.times import age_days, instant
from corpuswright.operators.classify import signal_count
from corpuswright.operators.hierarchy import ancestor_titles


def _weights(c: Column, table: dict[str, int], default: int) -> Column:
    chain = F.lit(default)
    for score in sorted(set(table.values())):
        chain = F.when(c.isin([k for k, v in table.items() if v == score]), F.lit(score)).otherwise(chain)
    return chain


def _clip(c: Column, low: int = 0, high: int = 100) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), c))


def quality_scores(df: DataFrame, as_of, *, weights=None, authority=None, freshness_days=None) -> DataFrame:
    """Add the struct ``quality`` of eight scores 0..100.

    Needs document_type, status_flags, updated_at, score_words, heading_count, signals, link_count.
    """
    weights = fv.SCORE_WEIGHTS if weights is None else weights
    authority = fv.AUTHORITY if authority is None else authority
    steps = fv.FRESHNESS_DAYS if freshness_days is None else freshness_days
    kind = F.col("document_type")
    archived = F.array_contains("status_flags", "archived")
    deprecated = F.array_contains("status_flags", "deprecated")
    prepared = df.withColumns(
        {"_age": age_days(F.col("updated_at"), instant(as_of)), "_signals": signal_count()}
    )
    fresh = (
        F.when(kind == "rca", fv.FRESHNESS_RCA)
        .when(archived | deprecated, fv.FRESHNESS_RETIRED)
        .when(F.col("_age").isNull(), fv.FRESHNESS_UNKNOWN)
    )
    for days, score in steps:
        fresh = fresh.when(F.col("_age") <= days, score)
    fresh = fresh.otherwise(fv.FRESHNESS_OLD)
    trust = _weights(kind, authority, authority.get("unknown", 10))
    trust = F.when(deprecated, F.greatest(trust - 50, F.lit(0))).otherwise(trust)
    trust = F.when(archived, F.greatest(trust - 40, F.lit(0))).otherwise(trust)
    words, heads = F.col("score_words"), F.col("heading_count")
    complete = (
        F.lit(20)
        + F.when(words >= 200, 20).otherwise(0)
        + F.when(words >= 800, 15).otherwise(0)
        + F.when(heads >= 3, 15).otherwise(0)
        + F.when(heads >= 8, 10).otherwise(0)
        + F.least(F.lit(20), F.col("_signals") * 3)
    )
    operational = (
        _weights(kind, fv.OPERATIONAL_BASE, 35)
        + F.least(F.lit(20), F.col("_signals") * 2)
        + F.least(F.lit(5), F.col("link_count"))
    )
    owner = (
        F.when(F.col("signals.has_owner"), 45).otherwise(0)
        + F.when(F.col("signals.has_support_group"), 35).otherwise(0)
        + F.when(F.col("signals.has_escalation_path"), 20).otherwise(0)
    )
    parts = prepared.withColumns(
        {
            "_fresh": fresh,
            "_trust": trust,
            "_complete": _clip(complete),
            "_operational": _clip(operational),
            "_owner": _clip(owner),
            "_contra": F.when(kind.isin("unknown", "meeting_notes", "project_plan"), 35).otherwise(10),
        }
    )
    total = (
        F.col("_fresh") * F.lit(weights["freshness"])
        + F.col("_trust") * F.lit(weights["authority"])
        + F.col("_complete") * F.lit(weights["completeness"])
        + F.col("_operational") * F.lit(weights["operational_value"])
        + F.col("_owner") * F.lit(weights["ownership_clarity"])
        - F.col("_contra") * F.lit(weights["contradiction_penalty"])
    )
    quality = F.struct(
        F.col("_fresh").alias("freshness_score"),
        F.col("_trust").alias("authority_score"),
        F.col("_complete").cast("int").alias("completeness_score"),
        F.col("_operational").cast("int").alias("operational_value_score"),
        F.col("_owner").alias("ownership_clarity_score"),
        F.greatest(F.lit(0), 100 - F.col("_fresh")).alias("staleness_risk_score"),
        F.col("_contra").alias("contradiction_risk_score"),
        _clip(F.rint(total)).cast("int").alias("overall_score"),
    )
    return parts.withColumn("quality", quality).drop(
        "_age", "_signals", "_fresh", "_trust", "_complete", "_operational", "_owner", "_contra"
    )


def quality_band(score: Column) -> Column:
    chain = F.lit("poor")
    for floor, name in sorted(fv.QUALITY_BANDS):
        chain = F.when(score >= floor, F.lit(name)).otherwise(chain)
    return chain


def quality_adjust(df: DataFrame) -> DataFrame:
    """Apply the hierarchy bonus, then the caps for empty and thin pages; add ``quality_band``."""
    q = F.col("quality")
    bonus = F.when(
        F.col("parent_context_type").isin("runbook", "support_model", "architecture"), 5
    ).otherwise(0) + F.when(F.col("page_role").isin("runbook_detail", "procedure_page"), 5).otherwise(0)
    # 0.4 of a bonus of 5 or 10 is a whole number
    raised = df.withColumn("_bonus", bonus).withColumn(
        "quality",
        q.withField(
            "completeness_score",
            F.when(
                F.col("is_index_page") & (q["completeness_score"] < 50),
                F.greatest(F.lit(0), q["completeness_score"] - 5),
            ).otherwise(q["completeness_score"]),
        )
        .withField("authority_score", F.least(F.lit(100), q["authority_score"] + F.col("_bonus")))
        .withField(
            "operational_value_score", F.least(F.lit(100), q["operational_value_score"] + F.col("_bonus"))
        )
        .withField(
            "overall_score",
            F.least(F.lit(100), q["overall_score"] + (F.col("_bonus") * 2 / 5).cast("int")),
        ),
    )
    empty = F.col("content_availability") == "empty"
    thin = F.col("content_availability") == "thin"

    def capped(name: str, if_empty: int, if_thin: int | None = None) -> Column:
        value = F.when(empty, F.least(q[name], F.lit(if_empty)))
        if if_thin is not None:
            value = value.when(thin, F.least(q[name], F.lit(if_thin)))
        return value.otherwise(q[name])

    return (
        raised.drop("_bonus")
        .withColumn(
            "quality",
            q.withField("completeness_score", capped("completeness_score", 10, 35))
            .withField("operational_value_score", capped("operational_value_score", 20))
            .withField("ownership_clarity_score", capped("ownership_clarity_score", 10))
            .withField("overall_score", capped("overall_score", 25, 55)),
        )
        .withColumn("quality_band", quality_band(F.col("quality.overall_score")))
    )


def page_confidence() -> Column:
    return F.least(
        F.lit(0.95),
        (F.col("document_type_confidence") + F.col("quality.overall_score") / F.lit(100.0)) / F.lit(2.0),
    )


def procedure_features(pages: DataFrame, *, max_chars: int | None = None) -> DataFrame:
    """Add ``has_linked_procedure`` and ``is_procedural`` (read from the text, no join).

    ``is_procedural`` reads the whole text, or its first ``max_chars`` characters.
    """
    said = F.lower(F.concat(F.col("title"), F.lit("\n"), F.col("text")))
    has_link = F.exists("links", lambda l: F.coalesce(l["href"], F.lit("")) != "")
    place = F.lower(
        F.concat_ws(
            "\n",
            F.col("title"),
            F.array_join(ancestor_titles(F.col("ancestors")), " "),
            tx.head(F.col("text"), max_chars),
        )
    )
    return (
        pages.withColumns({"_said": said, "_place": place})
        .withColumns(
            {
                "has_linked_procedure": has_link & tx.contains_any(F.col("_said"), fv.LINKED_PROCEDURE_TERMS),
                "is_procedural": tx.contains_any(F.col("_place"), fv.PROCEDURAL_TERMS)
                & ~tx.contains_any(F.col("_place"), fv.NON_PROCEDURAL_TERMS),
            }
        )
        .drop("_said", "_place")
    )


def quality_warnings(df: DataFrame) -> DataFrame:
    """Add the array ``warnings`` (archived, weak, ownerless, unvalidated, attachments)."""
    runbook = (F.col("document_type") == "runbook") & F.col("is_procedural")
    no_backout = runbook & ~F.col("signals.has_backout_steps")
    linked = F.col("has_linked_procedure")
    retired = F.arrays_overlap("status_flags", F.array(F.lit("archived"), F.lit("deprecated")))
    return df.withColumn(
        "warnings",
        F.array_compact(
            F.array(
                F.when(retired, "source_is_archived_or_deprecated"),
                F.when(F.col("quality.overall_score") < 50, "low_quality_score"),
                F.when(~F.col("signals.has_owner"), "missing_explicit_owner"),
                F.when(runbook & ~F.col("signals.has_validation_steps"), "missing_validation_steps"),
                F.when(no_backout & linked, "linked_procedure_not_expanded"),
                F.when(no_backout & ~linked, "missing_backout_steps"),
                F.when(F.col("attachment_count") > 0, "attachments_present_not_parsed"),
            )
        ),
    )
