"""Writers. One partitioned table per kind of row; Spark's commit protocol makes writes whole."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpuswright import schemas
from corpuswright.operators.reports import markdown_header, markdown_rows
from corpuswright.operators.rollups import ORDER, fact_trust_split
from corpuswright.session import check_shared


def write_enrichments(enriched: DataFrame, path: str) -> None:
    """All enrichment rows of a run, by space."""
    enriched.write.mode("overwrite").partitionBy("space_key").parquet(path)


def write_index_tables(tables: dict[str, DataFrame], root: str, **run) -> None:
    """The index tables; facts are split at 0.7 into ``facts`` and ``evidence_hints``.

    Rows are sorted inside each file: readers get ordered row groups without a global sort.
    """
    for name, df in tables.items():
        if name == "facts":
            trusted, hints = fact_trust_split(df)
            parts = {"facts": trusted, "evidence_hints": hints}
        else:
            parts = {name: df}
        for target, part in parts.items():
            contract = "facts" if target == "evidence_hints" else target
            rows = schemas.to_contract(part, contract, **run)
            keys = [c for c in [*ORDER, "image_id", "fact_id", "normalized_theme", "normalized_concept",
                                "entity_type", "normalized_name"] if c in rows.columns]
            rows.sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{root}/{target}")


def write_run_artifacts(root: str, **tables: DataFrame) -> None:
    """Append run tables (summary, failures, warnings, usage), partitioned by run."""
    for name, df in tables.items():
        rows = schemas.to_contract(df, name)
        rows.write.mode("append").partitionBy("run_id").parquet(f"{root}/{name}")


def write_document_export(rendered: DataFrame, path: str) -> None:
    """(path, content) rows of the text export, by space."""
    rendered.write.mode("overwrite").partitionBy("space_key").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report as Markdown table text: header file first, then the rows."""
    spark = report.sparkSession
    header = spark.createDataFrame([(line,) for line in markdown_header(report)], "value string")
    header.coalesce(1).write.mode("overwrite").text(f"{path}/header")
    markdown_rows(report).write.mode("overwrite").text(f"{path}/rows")


def write_files(rows: DataFrame, root: str) -> None:
    """One file per (path, content) row below ``root``, written by the tasks that hold the rows.

    ``root`` is a URI that pyarrow knows and every executor reaches, such as ``hdfs://`` or ``s3://``. A plain path or
    ``file://`` counts as shared only if it lies in ``spark.checkpoint.dir``, or if the master is local.
    """
    spark = rows.sparkSession
    check_shared(spark, root)

    def write(partition) -> None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        made = set()
        for row in partition:
            target = f"{base}/{row['path']}"
            folder = target.rsplit("/", 1)[0]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            with store.open_output_stream(target) as out:
                out.write(row["content"].encode("utf-8"))

    rows.select("path", "content").foreachPartition(write)
