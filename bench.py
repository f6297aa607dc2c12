"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402

HEADLINE = [
    "text_stats", "simhash64", "simhash_pairs", "near_title_pairs", "title_families", "duplicate_clusters",
    "hierarchy_counts", "classify_documents", "operational_signals", "quality_scores", "keyword_counts",
    "candidate_entities", "candidate_facts", "entity_rollup", "theme_rollup", "redact_secrets",
    "sensitivity_flags", "changed_only", "review_queue", "usage_report", "image_select", "chunk_documents",
    "document_index_rows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_DIR") or tempfile.mkdtemp(prefix="bench-"))
        # the tables are small files; without this a scan has a task or two for eight cores
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.sql.files.openCostInBytes", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = registry.queries()
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()  # start-up is not measured
    times = {}
    for name in names:
        start = time.perf_counter()
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}
        )
    )


if __name__ == "__main__":
    main()
