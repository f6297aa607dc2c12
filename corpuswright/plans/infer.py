"""The inference job: work items, chunks, prompts, cache, calls, validation, merge, usage and what went wrong."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.operators import inference as nf
from corpuswright.plans.enrich import Enriched
from corpuswright.session import cut_lineage

CACHE = "cache_key string, text string, answer_model string, input_tokens bigint, output_tokens bigint"


@dataclass(frozen=True)
class Inferred:
    pages: DataFrame  # enriched pages after the merge
    entities: DataFrame  # rule-based and new entities
    usage: DataFrame  # one row per answered call, with its cost
    failures: DataFrame  # calls that failed and answers that are not valid
    warnings: DataFrame  # cached answers asked again, texts that a limit cut
    cache: DataFrame  # new rows for the response cache


def infer(
    enriched: Enriched,
    pages: DataFrame,
    predict: Callable[[pd.DataFrame], pd.DataFrame],
    *,
    items: Sequence[nf.WorkItem],
    as_of,
    run_id: str,
    rates: DataFrame,
    config_hash: str,
    cache: DataFrame | None = None,
    metadata: Sequence[str] = ("document_id", "title", "chunk_index", "chunk_count"),
    templates: Mapping[str, str] | None = None,
    contracts: Mapping[str, str] | None = None,
    max_tokens: int = 8000,
    overlap_tokens: int = 200,
    max_chunks: int | None = None,
    parallelism: int | None = None,
    log: str | None = None,
    source_name: str | None = None,
) -> Inferred:
    """Ask the model about every chunk of ``pages`` and fold the valid answers into ``enriched``.

    The model is called once per distinct prompt without a valid cached answer; checked answers are written to the
    shared folder without their prompts, and everything returned is read from there. Pages whose calls fail keep their rule-based values.
    With ``log`` a run that was ended is taken up again without a second call for an answered prompt.
    """
    keys = enriched.pages.select("document_id", "title", "source_content_hash").withColumn("config_hash", F.lit(config_hash))
    chunks = nf.chunk_documents(pages.select("document_id", "text"), max_tokens=max_tokens, overlap_tokens=overlap_tokens, max_chunks=max_chunks)
    rows = nf.with_work_items(chunks.join(keys, "document_id"), items)
    prompts = cut_lineage(nf.build_prompts(rows, items, metadata=metadata, templates=templates, contracts=contracts).drop("chunk"))
    if cache is None:
        cache = pages.sparkSession.createDataFrame([], CACHE)
    split = nf.response_cache_join(prompts, cache)
    answered = nf.infer_batch(split.todo, predict, parallelism=parallelism, log=log)
    answers = nf.responses(split.hits, split.todo, answered)
    checked = cut_lineage(nf.validate_responses(nf.parse_responses(answers)).drop("prompt"))
    merged = nf.refinalize(nf.merge_responses(enriched.pages, checked, source_name=source_name), as_of)
    return Inferred(
        pages=merged,
        entities=nf.merged_entities(enriched.entities, checked, enriched.pages),
        usage=nf.usage_rows(checked, rates, run_id=run_id),
        failures=nf.inference_failures(checked),
        warnings=nf.inference_warnings(nf.response_cache_key(prompts), split.refreshed),
        cache=nf.cache_append(answered),
    )
