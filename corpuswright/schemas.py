"""Published row schemas. Timestamps are ISO-8601 text; unknown input fields are dropped."""

from __future__ import annotations

from pyspark.sql.types import StructType

from corpuswright import fixed_values as fv


def struct(ddl: str) -> StructType:
    """Schema object of one of the texts below (needs a running session)."""
    return StructType.fromDDL(ddl)


LINK = "struct<type:string,href:string,text:string,crawlable:boolean,target_page_id:string,target_space_key:string,target_title:string>"
HASHES = "struct<storage_sha256:string,export_view_sha256:string,markdown_sha256:string,text_sha256:string>"

# ---- input files ------------------------------------------------------------------------------
DATASET = (
    "source string, dataset_name string, base_url string, api_root string, crawl_type string, "
    "crawl_config map<string,string>, tool_version string, created_at string, updated_at string"
)
MANIFEST = (
    "markdown_path string, page_id string, path string, space_key string, status string, title string, "
    "updated_at string, version int"
)
MANIFEST_SUMMARY = ("spaces map<string,int>, status string, statuses map<string,int>, total_pages int")
EXPORT_ERRORS = ("operation string, page_id string, error string, timestamp string")
METADATA = (
    "ancestors array<struct<id:string,title:string>>, author struct<display_name:string,username:string>, "
    f"content_hashes {HASHES}, conversion_status string, created_at string, download_status string, "
    "labels array<string>, page_id string, space_key string, space_name string, status string, title string, "
    "url string, version int, updated_at string, retrieved_at string"
)
LINK_LIST = f"array<{LINK}>"
ANCESTORS = "array<struct<id:string,title:string>>"
LINKS = f"page_id string, links {LINK_LIST}"
CONVERSION = (
    "converter string, converter_version string, converted_at string, markdown_sha256 string, "
    "text_sha256 string, warnings array<string>"
)

# ---- the page row every per-page operator reads -------------------------------------------------
PAGES = (
    "page_id string, space_key string, title string, status string, updated_at string, url string, "
    f"labels array<string>, ancestors array<struct<id:string,title:string>>, content_hashes {HASHES}, "
    "links array<struct<type:string,href:string,text:string,target_title:string>>, "
    "attachment_names array<string>, markdown string, text string"
)

# ---- outputs ------------------------------------------------------------------------------------
SIGNALS = (", ".join(f"{name} boolean" for name in fv.SIGNAL_TERMS))
QUALITY = (
    "freshness_score int, authority_score int, completeness_score int, operational_value_score int, "
    "ownership_clarity_score int, staleness_risk_score int, contradiction_risk_score int, overall_score int"
)
_RUN = "schema_version string, run_id string, generated_at string, dataset_name string, "
_PAGE = _RUN + (
    "document_id string, page_id string, space_key string, source_updated_at string, source_content_hash string, "
)
MENTION = "struct<document_id:string,source_field:string,evidence:string>"
IMAGE = (
    "struct<image_id:string,source:string,source_kind:string,mime_type:string,content_sha256:string,"
    "status:string,ocr_text:string,caption:string,confidence:double,provider:string,model:string,"
    "prompt_version:string,cache_hit:boolean,error_type:string,error:string>"
)
CONTRACTS: dict[str, str] = {
    "document_index": (
        _PAGE + "title string, url string, retrieved_at string, version int, document_type string, "
        "document_type_confidence double, document_subtype string, content_availability string, "
        "quality_band string, status_flags array<string>, review_flags array<string>, audience string, "
        "sensitivity string, labels array<string>, ancestor_titles array<string>, outbound_link_count int, "
        "attachment_count int, word_count int, heading_count int, text_simhash string, heading_simhash string, "
        "hierarchy_depth int, parent_title string, root_title string, section_path string, page_role string, "
        "parent_context_type string, sibling_count int, child_count int"
    ),
    "quality_scores": (
        _PAGE + "quality_score int, quality_band string, dimensions map<string,int>, warnings array<string>"
    ),
    "themes": (_RUN + "theme_id string, theme string, normalized_theme string, document_count bigint, confidence double, method string"),
    "theme_members": ("theme_id string, document_id string"),
    "concepts": (
        _RUN + "concept_id string, concept string, normalized_concept string, description string, "
        "document_count bigint, confidence double, method string"
    ),
    "concept_members": ("concept_id string, document_id string"),
    "candidate_entities": (
        _RUN + "entity_id string, name string, normalized_name string, entity_type string, aliases array<string>, "
        f"document_count bigint, mentions array<{MENTION}>, confidence double, method string"
    ),
    "facts": (
        _PAGE + "fact_id string, subject string, predicate string, claim_type string, object string, "
        "evidence_text string, confidence double, extraction_method string"
    ),
    "visual_artifacts": (
        _PAGE + "extracted_at string, status string, method string, provider string, model string, "
        "prompt_version string, image_count int, images_succeeded int, images_failed int, images_skipped int, "
        f"images array<{IMAGE}>"
    ),
    "visual_index": (
        _PAGE + "image_id string, status string, source string, source_kind string, mime_type string, "
        "content_sha256 string, confidence double, caption string, ocr_text string, provider string, "
        "model string, prompt_version string, error_type string, error string"
    ),
    "page_failures": (
        _PAGE + "title string, stage string, error_type string, message string, retryable boolean, attempts int, "
        "suggested_action string, error_context map<string,string>"
    ),
    "warnings": (_PAGE + "title string, warning_type string, message string, stage string"),
    "model_usage": (
        _PAGE + "task string, provider string, model string, prompt_version string, input_tokens bigint, "
        "output_tokens bigint, cached boolean, attempts int, retries int, elapsed_ms bigint, estimated_cost_usd double"
    ),
    "run_summary": (
        _RUN + "command string, started_at string, finished_at string, elapsed_seconds double, status string, "
        "exit_code int, cache_path string, counts map<string,bigint>, outputs map<string,string>"
    ),
}


def table_contracts() -> dict[str, str]:
    """The published schemas as JSON, by table name."""
    return {name: struct(ddl).json() for name, ddl in CONTRACTS.items()}


def contract_differences(df, name: str) -> list[str]:
    """Columns of ``df`` that differ from the published schema (missing, extra, other type)."""
    want = {f.name: f.dataType.simpleString() for f in struct(CONTRACTS[name]).fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found = [f"missing {n}" for n in want if n not in have]
    found += [f"extra {n}" for n in have if n not in want]
    found += [f"{n}: {have[n]} is not {want[n]}" for n in want if n in have and have[n] != want[n]]
    return found


def to_contract(df, name: str, **literals):
    """Columns in contract order and type; ``literals`` fill run columns, absent ones become null."""
    from pyspark.sql import functions as F

    out = []
    for field in struct(CONTRACTS[name]).fields:
        if field.name in literals:
            value = F.lit(literals[field.name])
        elif field.name in df.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)
