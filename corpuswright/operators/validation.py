"""Corpus validation: manifest against files, as joins on the relative page path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright import fixed_values as fv

# file of a page -> issue code when it is absent
REQUIRED_FILES = {
    "metadata.json": "metadata_missing",
    "clean.md": "markdown_missing",
    "text.txt": "text_missing",
    "links.json": "links_missing",
    "conversion.json": "conversion_missing",
}
ISSUE = "level string, code string, message string, path string, page_id string"


def _issue(level: str, code: Column | str, message: Column, path: Column, page_id: Column) -> list[Column]:
    return [
        F.lit(level).alias("level"),
        (code if isinstance(code, Column) else F.lit(code)).alias("code"),
        message.alias("message"),
        path.alias("path"),
        page_id.alias("page_id"),
    ]


def expected_files(manifest: DataFrame) -> DataFrame:
    """(page_id, folder, path, code) of every file a successful page must have."""
    files = F.array(
        *[
            F.struct(
                (F.col("markdown_path") if name == "clean.md" else F.concat_ws("/", "path", F.lit(name))).alias("path"),
                F.lit(code).alias("code"),
            )
            for name, code in REQUIRED_FILES.items()
        ]
    )
    return manifest.where("status = 'success'").select(
        "page_id", F.col("path").alias("folder"), F.explode(files).alias("f")
    ).select("page_id", "folder", "f.path", "f.code")


def missing_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Issues for absent files and for pages without any file. ``files`` has relative ``path``."""
    present = files.select("path").distinct()
    absent = expected_files(manifest).join(present, "path", "left_anti")
    file_issues = absent.select(
        *_issue(
            "error", F.col("code"), F.concat(F.lit("Required page artifact missing: "), "path"),
            F.col("path"), F.col("page_id"),
        )
    )
    folders = files.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).distinct()
    # the folder of a page also exists through files in folders below it
    pages = manifest.where("status = 'success'").select("page_id", F.col("path").alias("folder"))
    no_folder = pages.join(folders, "folder", "left_anti")
    folder_issues = no_folder.select(
        *_issue(
            "error", "page_folder_missing", F.concat(F.lit("Required page artifact missing: "), "folder"),
            F.col("folder"), F.col("page_id"),
        )
    )
    return file_issues.unionByName(folder_issues)


def page_id_mismatch(manifest: DataFrame, metadata: DataFrame) -> DataFrame:
    """Issues for metadata naming another page than the manifest. ``metadata`` has ``folder``."""
    listed = manifest.where("status = 'success'").select(F.col("page_id").alias("listed_id"), F.col("path").alias("folder"))
    return (
        listed.join(metadata.select("folder", "page_id"), "folder")
        .where(F.col("page_id") != F.col("listed_id"))
        .select(
            *_issue(
                "error", "page_id_mismatch",
                F.concat(F.lit("metadata page_id "), "page_id", F.lit(" does not match manifest "), "listed_id"),
                F.concat_ws("/", "folder", F.lit("metadata.json")), F.col("listed_id"),
            )
        )
    )


def unreadable_files(manifest: DataFrame, parsed: DataFrame, name: str, code: str) -> DataFrame:
    """Issues for files whose JSON could not be read (``parsed`` has ``folder`` and ``_corrupt``)."""
    listed = manifest.where("status = 'success'").select(F.col("page_id").alias("listed_id"), F.col("path").alias("folder"))
    bad = parsed.where(F.col("_corrupt").isNotNull()).select("folder")
    return listed.join(bad, "folder").select(
        *_issue("error", code, F.lit(f"{name} is invalid"), F.concat_ws("/", "folder", F.lit(name)), F.col("listed_id"))
    )


def content_warnings(manifest: DataFrame, metadata: DataFrame, conversion: DataFrame) -> DataFrame:
    """Warnings for an absent Markdown hash and for conversion warnings."""
    listed = manifest.where("status = 'success'").select(F.col("page_id").alias("listed_id"), F.col("path").alias("folder"))
    no_hash = (
        listed.join(metadata.where("_corrupt is null").select("folder", "content_hashes"), "folder")
        .where(F.coalesce(F.col("content_hashes.markdown_sha256"), F.lit("")) == "")
        .select(
            *_issue(
                "warning", "markdown_hash_missing", F.lit("metadata content_hashes.markdown_sha256 is missing"),
                F.concat_ws("/", "folder", F.lit("metadata.json")), F.col("listed_id"),
            )
        )
    )
    converted = (
        listed.join(conversion.where("_corrupt is null").select("folder", "warnings"), "folder")
        .where(F.size("warnings") > 0)
        .select(
            *_issue(
                "warning", "conversion_warnings_present",
                F.concat(F.lit("conversion.json contains "), F.size("warnings").cast("string"), F.lit(" warning(s)")),
                F.concat_ws("/", "folder", F.lit("conversion.json")), F.col("listed_id"),
            )
        )
    )
    return no_hash.unionByName(converted)


def export_error_issue(errors: DataFrame) -> DataFrame:
    """One warning when the export itself reported errors."""
    return errors.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(
        *_issue(
            "warning", "export_errors_present",
            F.concat(F.lit("errors.jsonl contains "), F.col("n").cast("string"), F.lit(" exporter error(s)")),
            F.lit("errors.jsonl"), F.lit(None).cast("string"),
        )
    )


def validate_corpus(
    manifest: DataFrame,
    files: DataFrame,
    metadata: DataFrame,
    links: DataFrame,
    conversion: DataFrame,
    errors: DataFrame,
) -> DataFrame:
    """All issues of an export. Pages that were not exported successfully are not checked."""
    good = metadata.where("_corrupt is null")
    parts = [
        missing_files(manifest, files),
        unreadable_files(manifest, metadata, "metadata.json", "metadata_invalid"),
        unreadable_files(manifest, links, "links.json", "links_invalid"),
        unreadable_files(manifest, conversion, "conversion.json", "conversion_invalid"),
        page_id_mismatch(manifest, good),
        content_warnings(manifest, metadata, conversion),
        export_error_issue(errors),
    ]
    issues = parts[0]
    for part in parts[1:]:
        issues = issues.unionByName(part)
    return issues


def validation_summary(manifest: DataFrame, issues: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: pages, valid and failed pages, export errors, ok."""
    failed = issues.where("level = 'error' and page_id is not null").select("page_id").distinct().withColumn("bad", F.lit(1))
    pages = manifest.join(failed, "page_id", "left").agg(
        F.count(F.lit(1)).alias("pages_total"),
        F.count_if((F.col("status") == "success") & F.col("bad").isNull()).alias("pages_valid"),
        F.count_if((F.col("status") == "success") & F.col("bad").isNotNull()).alias("pages_failed"),
    )
    found = issues.agg(F.count_if(F.col("level") == "error").alias("error_issues"))
    told = errors.agg(F.count(F.lit(1)).alias("export_errors"))
    k = F.lit(1)
    return (
        pages.withColumn("_k", k)
        .join(found.withColumn("_k", k), "_k")
        .join(told.withColumn("_k", k), "_k")
        .select(
            "pages_total", "pages_valid", "pages_failed", "export_errors", (F.col("error_issues") == 0).alias("ok")
        )
    )


def validation_report(issues: DataFrame, *, limit: int | None = None) -> DataFrame:
    rows = issues.orderBy("level", "code", "page_id", "path")
    return rows if limit is None else rows.limit(limit)


def assemble_pages(manifest: DataFrame, *parts: DataFrame) -> DataFrame:
    """Successful pages with all their parts, joined on ``folder`` (a page lacking one is absent).

    ``parts`` are the metadata, links, conversion, Markdown and text tables, each with ``folder``. They are merged, never
    broadcast: Spark guesses their size by the manifest that names the files, and would take all texts into the driver.
    """
    df = manifest.where("status = 'success'").select(
        F.col("path").alias("folder"), "markdown_path", F.col("status").alias("manifest_status")
    )
    for part in parts:
        df = df.join(part.hint("merge"), "folder")
    return df


def constraint_violations(df: DataFrame, *, ranges=None, allowed=None) -> DataFrame:
    """(document_id, column, value) outside ``ranges`` {column: (low, high)} or ``allowed`` {column: values}.

    Reads like the output contract: scores 0..100, confidences 0..1, known document types.
    """
    ranges = (
        {"document_type_confidence": (0, 1), "confidence": (0, 1), "quality.overall_score": (0, 100)}
        if ranges is None
        else ranges
    )
    allowed = {"document_type": fv.DOCUMENT_TYPES} if allowed is None else allowed
    checks = [
        F.when(
            ~F.col(c).between(low, high) | F.col(c).isNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")),
        )
        for c, (low, high) in ranges.items()
    ] + [
        F.when(
            ~F.col(c).isin(list(values)) | F.col(c).isNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")),
        )
        for c, values in allowed.items()
    ]
    return df.select("document_id", F.explode(F.array_compact(F.array(*checks))).alias("v")).select(
        "document_id", "v.column", "v.value"
    )
