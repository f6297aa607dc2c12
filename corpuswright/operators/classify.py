"""Rule-based document type, subtype, status flags and operational signals.

Rules are plain lists compiled into one projection: no join, no Python in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx
from corpuswright.functions.times import age_days, instant
from corpuswright.operators.hierarchy import ancestor_titles


def _with_paths(pages: DataFrame, max_chars: int | None) -> DataFrame:
    titles = F.array_join(ancestor_titles(F.col("ancestors")), " ")
    return pages.withColumns(
        {
            "_title": F.lower("title"),
            "_path": F.lower(F.concat_ws("\n", F.col("title"), titles)),
            "_head": F.lower(
                F.concat(
                    F.col("title"), F.lit(" "), F.array_join("labels", " "), F.lit(" "), titles,
                    F.lit(" "), tx.head(F.col("text"), max_chars),
                )
            ),
        }
    )


def classify_documents(pages: DataFrame, *, overrides=None, type_terms=None, max_chars: int | None = None) -> DataFrame:
    """Add ``document_type`` and ``document_type_confidence``.

    Title overrides first (fixed confidence); else every type scores 1 per term found in title,
    labels, path or text (its first ``max_chars`` characters if given), 2 when it is in the title; best
    score wins, ties go to the earlier rule. Without any hit a page under 80 words is a reference.
    """
    overrides = fv.TITLE_OVERRIDES if overrides is None else overrides
    type_terms = fv.DOCUMENT_TYPE_TERMS if type_terms is None else type_terms
    df, in_head, stems = tx.with_stems(_with_paths(pages, max_chars), "_head", [t for terms in type_terms.values() for t in terms])
    fixed = F.lit(None).cast("struct<document_type:string,confidence:double>")
    for where, terms, mode, name, confidence in reversed(overrides):
        if where == "pattern":
            hit = F.col("_title").rlike(terms[0])
        else:
            hits = [F.col(f"_{where}").contains(t) for t in terms]
            hit = hits[0]
            for other in hits[1:]:
                hit = (hit & other) if mode == "all" else (hit | other)
        value = F.struct(F.lit(name).alias("document_type"), F.lit(float(confidence)).alias("confidence"))
        fixed = F.when(hit, value).otherwise(fixed)

    def points(terms: list[str]) -> Column:
        total = F.lit(0)
        for t in terms:
            in_title = F.col("_title").contains(t)
            total = total + F.when(in_title, 2).when(in_head(t), 1).otherwise(0)
        return total

    # the earliest of the best scores: larger score first, then smaller rule number
    scored = df.withColumn("_fixed", fixed).withColumn(
        "_best",
        F.array_max(
            F.array(
                *[
                    F.struct(
                        points(terms).alias("score"), F.lit(-i).alias("rank"), F.lit(name).alias("name")
                    )
                    for i, (name, terms) in enumerate(type_terms.items())
                ]
            )
        ),
    )
    few_words = tx.token_count(F.col("text")) < 80
    hit = F.col("_best.score") > 0
    return scored.withColumns(
        {
            "document_type": F.when(F.col("_fixed").isNotNull(), F.col("_fixed.document_type"))
            .when(hit, F.col("_best.name"))
            .when(few_words, F.lit("reference"))
            .otherwise(F.lit("unknown")),
            "document_type_confidence": F.when(F.col("_fixed").isNotNull(), F.col("_fixed.confidence"))
            .when(hit, F.least(F.lit(0.95), F.lit(0.55) + F.col("_best.score") * F.lit(0.08)))
            .when(few_words, F.lit(0.45))
            .otherwise(F.lit(0.35)),
        }
    ).drop("_title", "_path", "_head", "_fixed", "_best", *stems)


def document_subtypes(df: DataFrame, *, subtype_terms=None) -> DataFrame:
    """Add ``document_subtype`` and let it correct ``document_type``."""
    subtype_terms = fv.SUBTYPE_TERMS if subtype_terms is None else subtype_terms
    path = F.lower(
        F.concat(F.col("title"), F.lit("\n"), F.array_join(ancestor_titles(F.col("ancestors")), " "))
    )
    named = df.withColumn("_p", path)
    chain = F.when(F.col("document_type").isin(fv.SUBTYPE_FROM_TYPE), F.col("document_type"))
    for name, terms in reversed(list(subtype_terms.items())):
        chain = F.when(tx.contains_any(F.col("_p"), terms), F.lit(name)).otherwise(chain)
    typed = named.withColumn("document_subtype", chain).drop("_p")
    return typed.withColumn("document_type", type_for_subtype())


def type_for_subtype() -> Column:
    """Type after the subtype's say (always for strong subtypes, else only for ``unknown``)."""
    strong = _lookup(F.col("document_subtype"), fv.SUBTYPE_TYPE)
    weak = _lookup(F.col("document_subtype"), fv.SUBTYPE_TYPE_IF_UNKNOWN)
    return F.coalesce(
        strong, F.when(F.col("document_type") == "unknown", weak), F.col("document_type")
    )


def _lookup(c: Column, table: dict[str, str]) -> Column:
    by_value: dict[str, list[str]] = {}
    for k, v in table.items():
        by_value.setdefault(v, []).append(k)
    chain = F.lit(None).cast("string")
    for v, ks in by_value.items():
        chain = F.when(c.isin(ks), F.lit(v)).otherwise(chain)
    return chain


def currentness(df: DataFrame, as_of, *, flags: str = "status_flags") -> tuple[Column, Column]:
    """(historical, currentness) of a page."""
    retired = F.arrays_overlap(F.col(flags), F.array(F.lit("archived"), F.lit("deprecated")))
    rca = F.col("document_type") == "rca"
    age = age_days(F.col("updated_at"), instant(as_of))
    state = (
        F.when(retired, "deprecated")
        .when(rca, "historical")
        .when(age.isNull(), "unknown")
        .when(age > 730, "stale")
        .otherwise("current")
    )
    return retired | rca, state


def status_flags(df: DataFrame, as_of) -> DataFrame:
    """Add the sorted set ``status_flags`` plus ``historical`` and ``currentness``."""
    said = F.lower(
        F.concat(
            F.col("title"), F.lit(" "), F.array_join("labels", " "), F.lit(" "),
            F.coalesce("status", F.lit("")),
        )
    )
    archived = (F.col("document_type") == "archive") | said.contains("archive")
    deprecated = tx.contains_any(said, ["deprecated", "obsolete", "retired"])
    first = df.withColumn(
        "status_flags",
        F.array_compact(
            F.array(
                F.nullif(F.col("status"), F.lit("")),
                F.when(archived, F.lit("archived")),
                F.when(deprecated, F.lit("deprecated")),
            )
        ),
    )
    historical, state = currentness(first, as_of)
    flagged = first.withColumns({"_h": historical, "_s": state})
    flagged = flagged.withColumn(
        "status_flags",
        F.array_sort(
            F.array_distinct(
                F.array_compact(
                    F.concat("status_flags", F.array(F.when(F.col("_h"), F.lit("historical")), F.col("_s")))
                )
            )
        ),
    )
    # the final state is judged on the finished flags
    historical, state = currentness(flagged, as_of)
    return flagged.withColumns({"historical": historical, "currentness": state}).drop("_h", "_s")


def operational_signals(pages: DataFrame, *, signal_terms=None) -> DataFrame:
    """Add the struct ``signals`` of booleans: any term anywhere in title, text or link targets."""
    signal_terms = fv.SIGNAL_TERMS if signal_terms is None else signal_terms
    hrefs = F.array_join(F.transform("links", lambda l: F.coalesce(l["href"], F.lit(""))), " ")
    said = F.lower(F.concat(F.col("title"), F.lit(" "), F.col("text"), F.lit(" "), hrefs))
    df, has, stems = tx.with_stems(pages.withColumn("_said", said), "_said", [t for terms in signal_terms.values() for t in terms])
    fields = [tx.any_of(terms, has).alias(name) for name, terms in signal_terms.items()]
    return df.withColumn("signals", F.struct(*fields)).drop("_said", *stems)


def signal_count(signals: str = "signals", names=None) -> Column:
    total = F.lit(0)
    for name in names or fv.SIGNAL_TERMS:
        total = total + F.col(f"{signals}.{name}").cast("int")
    return total
