"""Scans of an exported corpus, earlier outputs and run history, with explicit schemas."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswright import schemas
from corpuswright.session import check_shared


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return bool(found) and len(found) > 0


def parse_json_lines(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Typed rows from JSON text lines; other columns of ``lines`` are kept.

    Blank lines are dropped. A line that is not a JSON object keeps its text in ``_corrupt``.
    """
    others = [c for c in lines.columns if c != value]
    parsed = F.from_json(
        F.col(value), schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    is_object = F.ltrim(F.col(value)).startswith("{")
    return (
        lines.where(F.trim(F.regexp_replace(value, r"[\r\n\t]", " ")) != "")
        .withColumn("_p", F.when(is_object, parsed))
        .select(
            *others,
            *[F.col("_p")[name].alias(name) for name in schemas.struct(schema).names],
            F.when(is_object, F.col("_p._corrupt")).otherwise(F.col(value)).alias("_corrupt"),
        )
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_corrupt").isNull()).drop("_corrupt")


def line_issues(parsed: DataFrame, code: str, path: Column | None = None) -> DataFrame:
    """Issue rows for unreadable lines."""
    return parsed.where(F.col("_corrupt").isNotNull()).select(
        F.lit("error").alias("level"), F.lit(code).alias("code"),
        F.concat(F.lit("invalid JSON line: "), F.substring("_corrupt", 1, 200)).alias("message"),
        (path if path is not None else F.lit(None).cast("string")).alias("path"),
        F.lit(None).cast("string").alias("page_id"),
    )


def scan_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with the file they came from and ``_corrupt``."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return parse_json_lines(lines, schema)


def scan_dataset(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.DATASET).option("multiLine", True).json(f"{root}/dataset.json")


def scan_manifest(spark: SparkSession, root: str, *, fail_fast: bool = False) -> DataFrame:
    """Manifest rows with ``_corrupt`` for bad lines; ``fail_fast`` raises on the first one read."""
    if fail_fast:
        return spark.read.schema(schemas.MANIFEST).option("mode", "FAILFAST").json(f"{root}/manifest.jsonl")
    return scan_json_lines(spark, f"{root}/manifest.jsonl", schemas.MANIFEST)


def scan_manifest_summary(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST_SUMMARY).option("multiLine", True).json(f"{root}/manifest.summary.json")


def scan_export_errors(spark: SparkSession, root: str) -> DataFrame:
    """Errors of the export; an absent file means none."""
    path = f"{root}/errors.jsonl"
    if not _exists(spark, path):
        return spark.createDataFrame([], schemas.EXPORT_ERRORS)
    return good_rows(scan_json_lines(spark, path, schemas.EXPORT_ERRORS)).drop("file")


def relative_path(file: Column, root: str) -> Column:
    """Path below ``root`` of a file URL as ``_metadata.file_path`` gives it (percent-encoded)."""
    base = root.rstrip("/").split("://", 1)[-1].lstrip("/")
    decoded = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
    plain = F.regexp_replace(decoded, r"^[a-zA-Z0-9]+:/+", "")
    return F.substring(plain, len(base) + 2, 1 << 20)


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``, listed once. Branches that ask for one file name open files of that name only.

    A filter on ``_metadata.file_name`` prunes the listing, and contents are read only where they are selected.
    """
    if not _exists(spark, root):
        raise FileNotFoundError(root)
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)


def _files_named(tree: DataFrame, root: str, name: str) -> DataFrame:
    """(folder, value) of the files called ``name``."""
    path = relative_path(F.col("_metadata.file_path"), root)
    return tree.where(F.col("_metadata.file_name") == name).select(
        _folder(path).alias("folder"), F.col("content").cast("string").alias("value")
    )


def scan_page_json(spark: SparkSession, root: str, name: str, schema: str, *, tree: DataFrame | None = None) -> DataFrame:
    """One JSON file per page (``name`` at any depth): typed columns, ``folder``, ``_corrupt``."""
    return parse_json_lines(_files_named(scan_tree(spark, root) if tree is None else tree, root, name), schema)


def scan_page_text(spark: SparkSession, root: str, name: str, column: str, *, tree: DataFrame | None = None) -> DataFrame:
    """One text file per page: (folder, column). Bad UTF-8 is replaced."""
    tree = scan_tree(spark, root) if tree is None else tree
    return _files_named(tree, root, name).select("folder", F.col("value").alias(column))


def scan_files(spark: SparkSession, root: str, *, tree: DataFrame | None = None) -> DataFrame:
    """(path, length) of every file below ``root``; contents are not read."""
    tree = scan_tree(spark, root) if tree is None else tree
    return tree.select(relative_path(F.col("_metadata.file_path"), root).alias("path"), "length")


def scan_attachments(files: DataFrame, *, own_files=(), folder: str = "attachments") -> DataFrame:
    """(folder, name, length) of attachment files; the export's own files are dropped."""
    parts = files.select(
        F.regexp_extract("path", rf"^(.*)/{folder}/([^/]+)$", 1).alias("folder"),
        F.regexp_extract("path", rf"^(.*)/{folder}/([^/]+)$", 2).alias("name"),
        "length",
    )
    lowered = F.lower("name")
    return parts.where((F.col("name") != "") & ~lowered.isin([*own_files, ""]) & ~lowered.startswith("manifest."))


def attachment_names(attachments: DataFrame) -> DataFrame:
    """(folder, attachment_names): a page's own files only, so a row stays small."""
    return attachments.groupBy("folder").agg(F.array_sort(F.collect_set("name")).alias("attachment_names"))


def _is_listed(name: str) -> bool:
    """Whether Spark's file sources see a file or folder of this name."""
    hidden = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
    return not hidden or name.startswith(("_common_metadata", "_metadata"))


PAGE_FILES = {"metadata.json": "metadata", "links.json": "links", "conversion.json": "conversion", "clean.md": "markdown", "text.txt": "text"}


def scan_page_files(spark: SparkSession, root: str, folders: DataFrame, *, attachments: str = "attachments") -> DataFrame:
    """(folder, a column for each of ``PAGE_FILES``, attachment_names) of the ``folder`` rows below ``root``.

    The tasks open the files and list the attachments of their own folders, so the driver lists nothing, however many
    pages there are. Absent files are null. ``root`` is a folder as ``sinks.write_files`` takes it.
    """
    check_shared(spark, root)
    schema = ", ".join(["folder string", *[f"{c} binary" for c in PAGE_FILES.values()], "attachment_names array<string>"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        base = base.rstrip("/")
        names = ["folder", *PAGE_FILES.values(), "attachment_names"]
        kinds = [pa.string(), *[pa.binary()] * len(PAGE_FILES), pa.list_(pa.string())]

        def content(path: str) -> bytes | None:
            try:
                with store.open_input_file(path) as file:
                    return file.read()
            except FileNotFoundError:
                return None
            except OSError:
                if store.get_file_info(path).type == fs.FileType.File:
                    raise
                return None

        for batch in batches:
            rows, held = [], 0
            for folder in batch.column(0).to_pylist():
                # only paths as a listing gives them name a folder
                if folder and (posixpath.normpath(folder) != folder or folder.startswith(("/", "..")) or not all(map(_is_listed, folder.split("/")))):
                    continue
                at = f"{base}/{folder}" if folder else base
                row = [folder, *[content(f"{at}/{name}") for name in PAGE_FILES]]
                listed = store.get_file_info(fs.FileSelector(f"{at}/{attachments}", allow_not_found=True))
                row.append([f.base_name for f in listed if f.type == fs.FileType.File and _is_listed(f.base_name)])
                rows.append(row)
                held += sum(len(c) for c in row[1:-1] if c is not None)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = folders.where("folder is not null").select("folder").repartition(parts, "folder").distinct()
    return dealt.mapInArrow(read, schema)


def scan_pages(spark: SparkSession, root: str, *, own_files=()) -> DataFrame:
    """The page rows of an export: manifest joined with the five files of every page.

    The manifest names the folders to read, so the tree is not listed; pages without one of the files are absent.
    """
    from corpuswright.operators.validation import assemble_pages

    manifest = good_rows(scan_manifest(spark, root))
    files = scan_page_files(spark, root, manifest.where("status = 'success'").select(F.col("path").alias("folder")))
    files = files.where(" and ".join(f"{c} is not null" for c in PAGE_FILES.values()))
    text = {c: F.col(c).cast("string").alias(c) for c in PAGE_FILES.values()}
    rows = files.select("folder", *text.values(), "attachment_names")
    rows = good_rows(parse_json_lines(rows.withColumnRenamed("links", "_links"), schemas.LINKS, "_links"))
    rows = good_rows(parse_json_lines(rows.drop("page_id"), schemas.CONVERSION, "conversion")).withColumnRenamed("warnings", "conversion_warnings")
    rows = good_rows(parse_json_lines(rows, schemas.METADATA, "metadata"))
    own = lambda n: ~F.lower(n).isin([*own_files, ""]) & ~F.lower(n).startswith("manifest.")
    names = F.array_sort(F.array_distinct(F.filter("attachment_names", own)))
    rows = rows.select("folder", *schemas.struct(schemas.METADATA).names, "links", "conversion_warnings", "markdown", "text", names.alias("attachment_names"))
    empty = F.array()
    return assemble_pages(manifest, rows).withColumns(
        {
            "labels": F.coalesce("labels", empty.cast("array<string>")),
            "links": F.coalesce("links", empty.cast(schemas.LINK_LIST)),
            "ancestors": F.coalesce("ancestors", empty.cast(schemas.ANCESTORS)),
        }
    )


# ---- earlier outputs ----------------------------------------------------------------------------


def scan_table(spark: SparkSession, path: str, name: str, *, skip_unreadable: bool = False) -> DataFrame:
    """An output table by its contract; an absent path is an empty table."""
    schema = schemas.CONTRACTS[name]
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("ignoreCorruptFiles", skip_unreadable).parquet(path)


def scan_index_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    names = ["document_index", "quality_scores", "themes", "concepts", "candidate_entities", "visual_index"]
    found = {n: scan_table(spark, f"{root}/{n}", n) for n in names}
    found["facts"] = scan_table(spark, f"{root}/facts", "facts")
    found["evidence_hints"] = scan_table(spark, f"{root}/evidence_hints", "facts")
    return found


def scan_enrichments(spark: SparkSession, path: str) -> DataFrame | None:
    """Earlier enrichment rows, or None when nothing readable was written yet.

    A file that cannot be read counts as absent and concerns no other file; ``skipped_files`` names it.
    """
    if not _exists(spark, path):
        return None
    try:
        # footers are read by tasks; the schema comes from the readable ones
        return spark.read.option("ignoreCorruptFiles", True).option("mergeSchema", True).parquet(path)
    except AnalysisException as no_schema:
        if no_schema.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def skipped_files(spark: SparkSession, path: str, rows: DataFrame | None) -> DataFrame:
    """(file, length) of the Parquet files below ``path`` that gave no row of ``rows``, which was read from there.

    One listing is held against the files that rows come from; contents are not read for it.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    ).select(F.col("_metadata.file_path").alias("file"), "length")
    if rows is None:
        return listed
    return listed.join(rows.select(F.col("_metadata.file_path").alias("file")).distinct(), "file", "left_anti")


def skipped_issues(skipped: DataFrame) -> DataFrame:
    """Issue rows for skipped files, as the validation of an export writes them."""
    return skipped.select(
        F.lit("warning").alias("level"), F.lit("unreadable_earlier_output").alias("code"),
        F.concat(F.lit("file gives no rows and counts as absent: "), F.col("length").cast("string"), F.lit(" bytes")).alias("message"),
        F.col("file").alias("path"), F.lit(None).cast("string").alias("page_id"),
    )


def scan_visual_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Artifact rows by their contract; a file that cannot be read counts as absent."""
    return scan_table(spark, path, "visual_artifacts", skip_unreadable=True)


def scan_run_history(
    spark: SparkSession, root: str, *, dataset_name: str, cache_path: str | None = None
) -> DataFrame:
    """Summaries of the runs of one dataset and one corpus path (a run without a path passes)."""
    runs = scan_table(spark, f"{root}/run_summary", "run_summary").where(F.col("dataset_name") == dataset_name)
    if cache_path is None:
        return runs
    same = F.coalesce(F.col("cache_path"), F.lit("")).isin("", cache_path)
    return runs.where(same)


def scan_run_usage(spark: SparkSession, root: str, runs: DataFrame, *, dataset_name: str) -> DataFrame:
    from corpuswright.operators.runs import rows_of_runs

    return rows_of_runs(scan_table(spark, f"{root}/model_usage", "model_usage"), runs, dataset_name=dataset_name)


def scan_run_failures(spark: SparkSession, root: str, runs: DataFrame, *, dataset_name: str) -> DataFrame:
    from corpuswright.operators.runs import rows_of_runs

    return rows_of_runs(scan_table(spark, f"{root}/page_failures", "page_failures"), runs, dataset_name=dataset_name)
