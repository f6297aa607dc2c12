"""Incremental refresh: carry unchanged enrichments over, recompute the rest."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGNATURE = [
    "source_content_hash", "prompt_version", "provider", "model_or_deployment", "tasks",
    "enrichment_config_hash",
]


def config_signature(settings: Mapping) -> str:
    """Stable hash of result-relevant settings (key order does not matter)."""
    text = json.dumps(settings, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def row_signature(struct: Column) -> Column:
    """The same idea per row: SHA-256 of the JSON of a struct column."""
    return F.sha2(F.to_json(struct), 256)


def changed_only(
    pages: DataFrame, stored: DataFrame, expected: Mapping[str, Column | str], *, force: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split into (carried enrichments, pages to recompute).

    ``stored`` holds ``document_id`` and the signature columns. Only ids and signatures are
    joined; every signature field is compared null-safe.
    """
    wanted = pages.select(
        "document_id",
        *[
            (v if isinstance(v, Column) else F.lit(v)).alias(f"_{k}")
            for k, v in expected.items()
        ],
    )
    same = F.lit(not force)
    for name in expected:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    unchanged = stored.join(wanted, "document_id").where(same).select("document_id")
    return stored.join(unchanged, "document_id", "left_semi"), pages.join(unchanged, "document_id", "left_anti")


def refreshed(carried: DataFrame, *, run_id: str, generated_at: str, dataset_name: str) -> DataFrame:
    """Carried rows with the identity of the new run."""
    return carried.withColumns(
        {
            "run_id": F.lit(run_id),
            "generated_at": F.lit(generated_at),
            "dataset_name": F.lit(dataset_name),
        }
    )


def filter_document_type(recomputed: DataFrame, document_type: str | None) -> DataFrame:
    """Keep one type among the recomputed rows (carried rows are not filtered)."""
    return recomputed if document_type is None else recomputed.where(F.col("document_type") == document_type)


def select_pages(pages: DataFrame, *, space: str | None = None, limit: int | None = None) -> DataFrame:
    """Successful pages, optionally of one space, then the first ``limit`` in page order."""
    chosen = pages.where(F.col("manifest_status") == "success")
    if space:
        chosen = chosen.where(F.col("space_key") == space)
    return chosen if limit is None else chosen.orderBy("space_key", "page_id").limit(limit)
