"""The export job: eligible pages rendered, redacted as a whole, and written or refused."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.operators import export as xp
from corpuswright.operators import redact as rd
from corpuswright.operators import runs as rn
from corpuswright.session import cut_lineage


@dataclass(frozen=True)
class Exported:
    documents: DataFrame  # document_id, space_key, page_id, title, path, content
    failures: DataFrame  # failure rows of refused pages
    warnings: DataFrame  # warning rows: redactions, text left out by a limit
    skipped: DataFrame  # pages that are not eligible, with their reason


def export(
    enriched: DataFrame,
    pages: DataFrame,
    *,
    dataset_name: str,
    run_id: str,
    review_flags=(),
    entities: DataFrame | None = None,
    links: bool = True,
    visuals: DataFrame | None = None,
    patterns=None,
    action: str = "redact",
    max_chars: int | None = None,
) -> Exported:
    """Render the eligible pages and redact the finished text, so no section can carry a secret out.

    Summaries, links, key facts and image texts are part of that text. With ``action="fail"`` a page with a secret is
    not exported and becomes a failure row. The redacted texts are written to the shared folder once; documents,
    failures and warnings read that table.
    """
    judged = xp.export_eligibility(enriched, review_flags=list(review_flags))
    ranked = xp.link_lines(xp.source_link_ranking(pages)) if links else None
    rendered = xp.render_documents(
        judged.where("eligible"), pages, dataset_name=dataset_name, run_id=run_id, links=ranked, visuals=visuals, max_chars=max_chars,
        entity_lines=None if entities is None else xp.display_entities(entities),
    )
    clean = cut_lineage(rd.redact_secrets(rendered, "content", patterns=patterns, action=action))
    told = clean.withColumn("all_warnings", F.concat("render_warnings", "redaction_warnings"))
    refused = clean.where("redaction_failed")
    return Exported(
        documents=clean.where("not redaction_failed").drop("render_warnings", "redaction_warnings", "redaction_failed"),
        failures=rn.failure_rows(
            refused, run_id=run_id, stage="export", error_type="RedactionRefused", message=F.array_join("redaction_warnings", ", "), retryable=False
        ),
        warnings=rn.warning_rows(told, "all_warnings", run_id=run_id, stage="export"),
        skipped=judged.where("not eligible"),
    )
