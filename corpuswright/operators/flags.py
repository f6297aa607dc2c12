"""Review flags: sensitivity, trust, missing content, usability; audience and sensitivity class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx
from corpuswright.functions.times import instant

DAY_MONTH_YEAR = (
    r"(?i)\b(\d{1,2})[\s/-]+(jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*[\s/-]+(20\d{2})\b"
)
YEAR_MONTH_DAY = r"\b(20\d{2})-(\d{1,2})-(\d{1,2})\b"


def _sorted_set(*flags: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*flags))))


def sensitivity_flags(df: DataFrame, *, inside_domains=(), case_terms=None, person_id: str | None = None) -> DataFrame:
    """Add ``sensitivity_flags``: e-mails, outside e-mails, person ids, log links, customer cases.

    ``person_id`` is the pattern of the caller's person numbers; without it there are none.
    """
    case_terms = fv.CUSTOMER_CASE_TERMS if case_terms is None else case_terms
    hrefs = F.array_join(F.transform("links", lambda l: F.coalesce(l["href"], F.lit(""))), " ")
    said = F.concat_ws("\n", F.col("title"), F.array_join("labels", " "), F.col("text"), hrefs)

    def outside(mail: Column) -> Column:
        lowered = F.lower(mail)
        inside = F.lit(False)
        for domain in inside_domains:
            inside = inside | lowered.endswith(domain)
        return ~inside

    found = (
        df.withColumn("_said", said)
        .withColumns(
            {
                "_mails": F.when(F.col("_said").contains("@"), F.regexp_extract_all("_said", F.lit(fv.EMAIL), 0)).otherwise(
                    F.array().cast("array<string>")
                ),
                "_person": F.lit(False) if person_id is None else F.col("_said").rlike(person_id),
                "_low": F.lower("_said"),
            }
        )
        .withColumns(
            {
                "_outside": F.exists("_mails", outside),
                "_logs": tx.contains_any(F.col("_low"), fv.LOG_LINK_TERMS),
            }
        )
    )
    case = tx.contains_any(F.col("_low"), case_terms) & (
        F.col("_outside") | F.col("_person") | F.col("_logs")
    )
    return (
        found.withColumn("_case", case)
        .withColumn(
            "sensitivity_flags",
            _sorted_set(
                F.when(F.size("_mails") > 0, "contains_email_addresses"),
                F.when(F.col("_outside"), "contains_customer_emails"),
                F.when(F.col("_person"), "contains_person_identifiers"),
                F.when(F.col("_logs"), "contains_log_links"),
                F.when(F.col("_case"), "contains_customer_case_data"),
                F.when(
                    F.col("_outside") | F.col("_person") | F.col("_case"), "requires_restricted_audience"
                ),
            ),
        )
        .drop("_said", "_mails", "_person", "_low", "_outside", "_logs", "_case")
    )


def audience(flags: Column) -> Column:
    return F.when(F.array_contains(flags, "requires_restricted_audience"), "restricted_internal").otherwise(
        "internal"
    )


def sensitivity(flags: Column) -> Column:
    return (
        F.when(F.array_contains(flags, "contains_customer_case_data"), "customer_confidential")
        .when(
            F.array_contains(flags, "contains_customer_emails")
            | F.array_contains(flags, "contains_person_identifiers"),
            "restricted",
        )
        .otherwise("internal")
    )


def has_future_date(text: Column, as_of) -> Column:
    """Any written date after the day of ``as_of``; impossible dates are ignored."""
    today = F.to_date(F.date_format(F.to_utc_timestamp(instant(as_of), F.current_timezone()), "yyyy-MM-dd"))
    named = F.transform(
        F.regexp_extract_all(text, F.lit(DAY_MONTH_YEAR), 0),
        lambda m: F.try_to_date(
            F.concat_ws(
                "-",
                F.regexp_extract(m, DAY_MONTH_YEAR, 3),
                _month(F.lower(F.substring(F.regexp_extract(m, DAY_MONTH_YEAR, 2), 1, 3))),
                F.lpad(F.regexp_extract(m, DAY_MONTH_YEAR, 1), 2, "0"),
            ),
            "yyyy-MM-dd",
        ),
    )
    numbered = F.transform(
        F.regexp_extract_all(text, F.lit(YEAR_MONTH_DAY), 0),
        lambda m: F.try_to_date(
            F.concat_ws(
                "-",
                F.regexp_extract(m, YEAR_MONTH_DAY, 1),
                F.lpad(F.regexp_extract(m, YEAR_MONTH_DAY, 2), 2, "0"),
                F.lpad(F.regexp_extract(m, YEAR_MONTH_DAY, 3), 2, "0"),
            ),
            "yyyy-MM-dd",
        ),
    )
    found = F.exists(F.concat(named, numbered), lambda d: F.coalesce(d > today, F.lit(False)))
    return F.when(~text.contains("20"), F.lit(False)).otherwise(found)  # both forms hold a year 20..


def _month(name: Column) -> Column:
    months = F.lit("janfebmaraprmayjunjulaugsepoctnovdec")
    return F.lpad(((F.position(name, months) + 2) / 3).cast("int").cast("string"), 2, "0")


def future_dates(df: DataFrame, as_of) -> DataFrame:
    return df.withColumn("has_future_date", has_future_date(F.col("text"), as_of))


def trust_flags(df: DataFrame, as_of, *, max_chars: int | None = None) -> DataFrame:
    """Add ``trust_flags``: draft, wip, internal, unresolved, versioned, future-dated, review.

    Reads the whole text, or its first ``max_chars`` characters.
    """
    title = F.lower("title")
    labels = F.lower(F.array_join("labels", " "))
    early = F.lower(tx.head(F.col("text"), max_chars))
    seen = df.withColumns(
        {"_title": title, "_labels": labels, "_seen": F.concat_ws("\n", title, labels, early)}
    ).withColumn("_future", has_future_date(F.col("text"), as_of))
    draft = F.col("_title").rlike(fv.DRAFT_TITLE) | F.col("_seen").contains("status draft")
    wip = F.col("_title").contains("wip") | F.col("_seen").contains("work in progress")
    unresolved = tx.contains_any(F.col("_seen"), fv.UNRESOLVED_TERMS)
    versioned = (
        (F.col("document_type") == "runbook")
        | F.coalesce(F.col("document_subtype").isin(fv.VERSIONED_SUBTYPES), F.lit(False))
        | tx.contains_any(F.col("_title"), fv.VERSIONED_TITLE_TERMS)
    ) & F.col("_title").rlike(r"\b\d+\.\d+(?:\.\d+)?\b")
    internal = F.col("_title").contains("internal") | F.col("_labels").contains(" internal")
    checked = seen.withColumns({"_draft": draft, "_wip": wip, "_open": unresolved})
    return checked.withColumn(
        "trust_flags",
        _sorted_set(
            F.when(F.col("_draft"), "draft"),
            F.when(F.col("_draft") | F.col("_wip"), "not_for_execution"),
            F.when(F.col("_wip"), "wip"),
            F.when(internal, "internal_only"),
            F.when(F.col("_open"), "contains_unresolved_items"),
            F.when(versioned, "versioned_operational_document"),
            F.when(F.col("_future"), "future_dated"),
            F.when(F.col("_future"), "not_for_execution_until_verified"),
            F.when(
                F.col("_draft") | F.col("_wip") | F.col("_open") | F.col("_future"), "manual_review_required"
            ),
        ),
    ).drop("_title", "_labels", "_seen", "_future", "_draft", "_wip", "_open")


def missing_content_flags(df: DataFrame) -> DataFrame:
    """Add ``missing_content_flags`` from images without extraction and attachments not exported.

    Reads ``visual_status`` and ``images_succeeded`` (null without an earlier extraction) and
    ``missing_attachment_names``.
    """
    images = F.regexp_count("markdown", F.lit(tx.MARKDOWN_IMAGE))
    df = df.withColumn("_images", images)
    has = F.col("_images") > 0
    complete = has & F.coalesce(F.col("visual_status") == "complete", F.lit(False))
    partly = has & ~complete & (F.coalesce("images_succeeded", F.lit(0)) > 0)
    absent = has & ~complete & ~partly
    poor = absent & ((F.col("_images") >= 3) | (tx.word_count(F.col("text")) < 150))
    gap = F.size("missing_attachment_names") > 0

    def valuable(name: Column) -> Column:
        lowered = F.lower(F.substring_index(name, "?", 1))
        hit = F.lit(False)
        for suffix in fv.HIGH_VALUE_SUFFIXES:
            hit = hit | lowered.endswith(suffix)
        return hit

    important = gap & (
        F.coalesce(F.col("document_subtype").isin("api_specification", "performance_test_report"), F.lit(False))
        | F.exists("missing_attachment_names", valuable)
        | F.col("document_type").isin("design", "architecture")
    )
    return df.withColumn(
        "missing_content_flags",
        _sorted_set(
            F.when(complete, "visual_content_extracted"),
            F.when(partly, "visual_content_partially_extracted"),
            F.when(partly | absent, "visual_content_missing"),
            F.when(partly | poor, "visual_content_review_recommended"),
            F.when(gap, "attachment_content_missing"),
            F.when(important, "attachment_content_review_recommended"),
            F.when(partly | poor | important, "manual_review_required"),
        ),
    ).drop("_images")


def usability_flags(df: DataFrame) -> DataFrame:
    """Add ``usability_flags`` for table rows of more than 1 200 characters."""
    rows = F.size(
        F.filter(tx.lines(F.col("markdown")), lambda l: (F.length(l) > 1200) & l.rlike(r"(?U)^\s*\|"))
    )
    return df.withColumn("_rows", rows).withColumn(
        "usability_flags",
        _sorted_set(
            F.when(F.col("_rows") > 0, "source_contains_oversized_table_rows"),
            F.when(F.col("_rows") > 0, "manual_review_required"),
            F.when(F.col("_rows") >= 3, "table_rendering_review_recommended"),
        ),
    ).drop("_rows")


def review_flags_union(df: DataFrame) -> DataFrame:
    """Union the four flag sets and the availability flag; add audience and sensitivity."""
    extra = F.array_compact(
        F.array(
            F.when(F.col("content_availability") == "empty", "no_exportable_body_content").when(
                F.col("content_availability") == "thin", "thin_source_content"
            )
        )
    )
    return df.withColumn(
        "review_flags",
        F.array_sort(
            F.array_distinct(
                F.concat("sensitivity_flags", "trust_flags", "missing_content_flags", "usability_flags", extra)
            )
        ),
    ).withColumns(
        {"audience": audience(F.col("review_flags")), "sensitivity": sensitivity(F.col("review_flags"))}
    )


def attachment_gap(pages: DataFrame, *, own_files=(), attachment_type: str = "attachment") -> DataFrame:
    """Add linked, missing and referenced attachment names and ``attachment_count``.

    ``own_files`` are names the export itself writes beside attachments; they never count.
    """
    def foreign(name: Column) -> Column:
        lowered = F.lower(F.substring_index(name, "/", -1))
        return (name != "") & ~lowered.isin([*own_files, ""]) & ~lowered.startswith("manifest.")

    linked = F.filter(
        "links",
        lambda l: (F.coalesce(l["type"], F.lit("")) == attachment_type)
        | F.coalesce(l["href"], F.lit("")).contains("/download/attachments/"),
    )

    def link_name(l: Column) -> Column:
        path = F.regexp_replace(F.substring_index(F.coalesce(l["href"], F.lit("")), "?", 1), "/+$", "")
        return tx.strip(F.coalesce(F.nullif(l["text"], F.lit("")), F.substring_index(path, "/", -1)))

    return (
        pages.withColumns(
            {
                "attachment_names": F.array_sort(F.array_distinct(F.filter("attachment_names", foreign))),
                "linked_attachment_names": F.array_sort(
                    F.array_distinct(F.filter(F.transform(linked, link_name), foreign))
                ),
            }
        )
        .withColumns(
            {
                "missing_attachment_names": F.array_except("linked_attachment_names", "attachment_names"),
                "referenced_attachment_names": F.array_sort(
                    F.array_union("attachment_names", "linked_attachment_names")
                ),
            }
        )
        .withColumn("attachment_count", F.size("referenced_attachment_names"))
    )
