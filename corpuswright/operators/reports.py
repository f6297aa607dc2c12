"""Audit reports: each one is a DataFrame over the index tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx
from corpuswright.session import broadcast_if_small

PLACE = ["space_key", "page_id"]
OPERATIONAL = ["runbook", "support_model", "architecture"]
LOW_AUTHORITY = ["meeting_notes", "project_plan", "change_record"]


def _has(column: str, *flags: str) -> Column:
    return F.arrays_overlap(column, F.array(*[F.lit(f) for f in flags]))


def _top(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of an ordered frame, or all of them."""
    return rows if limit is None else rows.limit(limit)


def quality_lookup(index: DataFrame, quality: DataFrame) -> DataFrame:
    """Index rows with ``quality`` (0 when a document has no score)."""
    scores = quality.select("document_id", F.col("quality_score").alias("quality"))
    return index.join(scores, "document_id", "left").withColumn("quality", F.coalesce("quality", F.lit(0)))


def stale_or_deprecated(index: DataFrame, *, limit: int | None = None) -> DataFrame:
    rows = index.where(_has("status_flags", "stale", "deprecated", "archived")).orderBy(*PLACE).select(
        *PLACE, "title", "status_flags", "url"
    )
    return _top(rows, limit)


def missing_owners(enriched: DataFrame, *, limit: int | None = None) -> DataFrame:
    rows = (
        enriched.where(~F.col("signals.has_owner") & (F.col("quality.overall_score") >= 50))
        .orderBy(*PLACE)
        .select(*PLACE, "document_type", "title")
    )
    return _top(rows, limit)


def corpus_summary(index: DataFrame, quality: DataFrame) -> DataFrame:
    docs = index.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(_has("status_flags", "stale", "deprecated", "archived")).alias("stale_documents"),
    )
    scores = quality.agg(
        F.coalesce(F.rint(F.avg("quality_score")).cast("bigint"), F.lit(0)).alias("average_quality"),
        F.count_if(F.col("quality_score") >= 70).alias("good_documents"),
    )
    # two one-row tables side by side
    return docs.withColumn("_k", F.lit(1)).join(scores.withColumn("_k", F.lit(1)), "_k").drop("_k")


def document_types(index: DataFrame) -> DataFrame:
    return index.groupBy("document_type").agg(F.count(F.lit(1)).alias("documents"))


def availability_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("content_availability").agg(F.count(F.lit(1)).alias("documents"))


def subtree_value(enriched: DataFrame, *, limit: int | None = 100, roles: int | None = None) -> DataFrame:
    """Sections (parent title, else root title) by mean quality and size, with all or the first ``roles`` of their page roles."""
    section = F.coalesce(
        F.nullif("parent_title", F.lit("")), F.nullif("root_title", F.lit("")), F.lit("unknown")
    )
    grouped = enriched.groupBy(section.alias("section")).agg(
        F.count(F.lit(1)).alias("pages"),
        F.rint(F.avg("quality.overall_score")).cast("bigint").alias("average_quality"),
        F.count_if(F.col("document_type").isin(OPERATIONAL)).alias("operational_pages"),
        F.array_join(tx.first(F.array_sort(F.collect_set("page_role")), roles), ", ").alias("roles"),
        F.min(F.struct(*PLACE)).alias("_first"),
    )
    return grouped.orderBy(F.desc("average_quality"), F.desc("pages"), "_first").transform(_top, limit).drop("_first")


# ---- ranked review tables --------------------------------------------------------------------


def review_penalty() -> Column:
    title = tx.normalize_term(F.col("title"))
    kind = F.col("document_type")

    def points(when: Column, n: int) -> Column:
        return F.when(when, n).otherwise(0)

    return (
        points(kind.isin(LOW_AUTHORITY), 20)
        + points(kind.isin("archive", "unknown"), 35)
        + points(_has("status_flags", "archived", "deprecated"), 30)
        + points(_has("status_flags", "stale"), 10)
        + points(tx.contains_any(title, ["handover", "service review meeting"]), 25)
        + points(tx.contains_any(title, ["release", "rollback", "report"]), 15)
        + points(tx.contains_any(title, ["draft", "rejected", "template"]), 25)
        + points(_has("review_flags", "future_dated"), 20)
    )


def review_reasons() -> Column:
    title = tx.normalize_term(F.col("title"))
    found = F.array_compact(
        F.array(
            F.when(F.col("document_type").isin(OPERATIONAL), "operational_source"),
            F.when(F.col("document_type").isin(LOW_AUTHORITY), "lower_authority_type"),
            F.when(_has("status_flags", "stale", "archived", "deprecated"), "currentness_risk"),
            F.when(
                tx.contains_any(title, ["handover", "service review meeting", "release", "rollback"]),
                "dated_operational_record",
            ),
            F.when(_has("review_flags", "future_dated"), "future_dated"),
        )
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("candidate_canonical_source")))


def high_value_sources(index: DataFrame, quality: DataFrame, *, limit: int | None = 100) -> DataFrame:
    rows = quality_lookup(index, quality).withColumn("priority", F.col("quality") - review_penalty())
    return (
        rows.orderBy(F.desc("priority"), F.desc("outbound_link_count"), F.desc("word_count"), *PLACE)
        .transform(_top, limit)
        .select(
            *PLACE, "quality", "priority", "document_type",
            F.array_join(review_reasons(), ", ").alias("reason"), "title", "url",
        )
    )


def review_priority() -> Column:
    def points(when: Column, n: int) -> Column:
        return F.when(when, n).otherwise(0)

    return F.greatest(
        F.lit(0),
        F.col("quality")
        - review_penalty()
        + points(_has("review_flags", "manual_review_required"), 30)
        + points(F.col("document_type").isin(OPERATIONAL), 15)
        + points(_has("review_flags", "visual_content_missing", "attachment_content_missing"), 10)
        + points(~F.col("sensitivity").isin("internal", "public"), 10),
    )


def review_queue(index: DataFrame, quality: DataFrame, *, limit: int | None = 200) -> DataFrame:
    rows = quality_lookup(index, quality).withColumn("priority", review_priority())
    manual = _has("review_flags", "manual_review_required")
    reasons = F.array_distinct(
        F.concat(
            review_reasons(),
            F.array_compact(
                F.array(
                    F.when(manual, "manual_review_required"),
                    F.when(~F.col("sensitivity").isin("internal", "public"), "sensitive_content"),
                    F.when(_has("review_flags", "visual_content_missing"), "visual_content_missing"),
                    F.when(_has("review_flags", "attachment_content_missing"), "attachment_content_missing"),
                )
            ),
        )
    )
    return (
        rows.where((F.col("priority") >= 40) | manual)
        .orderBy(F.desc("priority"), *PLACE)
        .transform(_top, limit)
        .select(
            "priority", *PLACE, "document_type", F.coalesce("document_subtype", F.lit("")).alias("document_subtype"),
            "quality", F.array_join(reasons, ", ").alias("reasons"), "title", "url",
        )
    )


def attachment_followups(index: DataFrame, *, limit: int | None = 200) -> DataFrame:
    return (
        index.where("attachment_count > 0")
        .orderBy(F.desc("attachment_count"), *PLACE)
        .transform(_top, limit)
        .select(*PLACE, "attachment_count", "title", "url")
    )


def risk_flags_intersect(flags: Column) -> Column:
    return F.array_intersect(flags, F.array(*[F.lit(f) for f in fv.HIGH_RISK_FLAGS]))


def risk_score() -> Column:
    return (
        F.when(F.col("audience") == "restricted_internal", 30).otherwise(0)
        + F.when(~F.col("sensitivity").isin("internal", "public"), 30).otherwise(0)
        + 10 * F.size(risk_flags_intersect(F.col("review_flags")))
    )


def export_risk(index: DataFrame, *, limit: int | None = None) -> DataFrame:
    reasons = F.concat(
        F.array_compact(
            F.array(
                F.when(F.col("audience") == "restricted_internal", "restricted_audience"),
                F.when(~F.col("sensitivity").isin("internal", "public"), F.col("sensitivity")),
            )
        ),
        F.array_sort(risk_flags_intersect(F.col("review_flags"))),
    )
    rows = (
        index.withColumn("risk", risk_score())
        .where("risk > 0")
        .orderBy(F.desc("risk"), *PLACE)
        .select(*PLACE, "risk", "audience", "sensitivity", F.array_join(reasons, ", ").alias("reasons"), "title", "url")
    )
    return _top(rows, limit)


def risk_gate(index: DataFrame, *, threshold: int | None, action: str = "warn") -> DataFrame:
    """One row (action, threshold, risky_pages, note); ``fail`` raises when pages reach it."""
    counted = index.agg(
        F.count_if(risk_score() >= threshold).alias("risky_pages")
        if threshold is not None and action != "off"
        else F.lit(0).cast("bigint").alias("risky_pages")
    )
    if action == "off":
        note = F.lit("Risk gate: off.")
    elif threshold is None:
        note = F.lit(f"Risk gate: {action}, no threshold configured.")
    else:
        note = F.concat(
            F.lit(f"Risk gate: {action} at threshold {threshold}; "),
            F.col("risky_pages").cast("string"),
            F.lit(" page(s) meet or exceed the threshold."),
        )
    result = counted.select(
        F.lit(action).alias("action"), F.lit(threshold).cast("int").alias("threshold"), "risky_pages", note.alias("note")
    )
    if action == "fail" and threshold is not None:
        row = result.first()
        if row["risky_pages"]:
            raise ValueError(row["note"])
    return result


# ---- entities and facts ----------------------------------------------------------------------

LINK_TYPES = ["url", "contact", "ticket"]


def entity_tier() -> Column:
    return (
        F.when(F.col("entity_type").isin(LINK_TYPES), "contact_link_record")
        .when(
            (F.col("confidence") >= 0.7) & (F.col("document_count") >= 2) & (F.col("entity_type") != "technology"),
            "canonical_candidate",
        )
        .otherwise("weak_signal")
    )


def entity_quality(entities: DataFrame) -> DataFrame:
    """(measure, key, entities): totals, counts per type and per tier in one pass."""
    rows = entities.select("entity_type", "confidence", entity_tier().alias("tier"))
    keyed = rows.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.lit("total").alias("measure"), F.lit("entities").alias("key")),
                    F.struct(F.lit("type").alias("measure"), F.col("entity_type").alias("key")),
                    F.struct(F.lit("tier").alias("measure"), F.col("tier").alias("key")),
                    F.when(
                        F.col("entity_type").isin(LINK_TYPES),
                        F.struct(F.lit("total").alias("measure"), F.lit("links_contacts_tickets").alias("key")),
                    ),
                    F.when(
                        F.col("confidence") < 0.5,
                        F.struct(F.lit("total").alias("measure"), F.lit("low_confidence").alias("key")),
                    ),
                )
            )
        ).alias("k")
    )
    return keyed.groupBy("k.measure", "k.key").agg(F.count(F.lit(1)).alias("entities"))


def noisy_union_low_confidence(entities: DataFrame, *, limit: int | None = None) -> DataFrame:
    """Link-like entities and low-confidence ones; an entity that is both is listed twice."""
    cols = [entity_tier().alias("tier"), "entity_type", "name", "document_count", "confidence"]
    noisy = entities.where(F.col("entity_type").isin(LINK_TYPES)).select(*cols)
    weak = entities.where("confidence < 0.5").select(*cols)
    return noisy.unionByName(weak).orderBy("entity_type", "name").transform(_top, limit)


def fact_quality(facts: DataFrame, *, predicates: int | None = None) -> DataFrame:
    """(measure, key, facts): totals, claim types, predicates (the ``predicates`` most frequent if given)."""
    keyed = facts.select(
        F.explode(
            F.array(
                F.struct(F.lit("total").alias("measure"), F.lit("facts").alias("key")),
                F.struct(
                    F.lit("total").alias("measure"),
                    F.when(F.col("confidence") >= 0.7, "usable").otherwise("hints").alias("key"),
                ),
                F.struct(F.lit("claim_type").alias("measure"), F.col("claim_type").alias("key")),
                F.struct(F.lit("predicate").alias("measure"), F.col("predicate").alias("key")),
            )
        ).alias("k")
    )
    counts = keyed.groupBy("k.measure", "k.key").agg(F.count(F.lit(1)).alias("facts"))
    top = counts.where("measure = 'predicate'").orderBy(F.desc("facts"), "key").transform(_top, predicates)
    return counts.where("measure <> 'predicate'").unionByName(top)


# ---- usage and failures ----------------------------------------------------------------------


def usage_report(usage: DataFrame) -> DataFrame:
    """Calls, tokens, cache hits, retries and cost by provider, model and task."""
    live = ~F.col("cached")

    def total(name: str, when: Column | None = None) -> Column:
        value = F.coalesce(name, F.lit(0))
        return F.sum(value if when is None else F.when(when, value).otherwise(0))

    return usage.groupBy("provider", "model", "task").agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(live).alias("live_calls"),
        total("input_tokens").alias("input_tokens"),
        total("output_tokens").alias("output_tokens"),
        total("input_tokens", live).alias("live_input_tokens"),
        total("output_tokens", live).alias("live_output_tokens"),
        F.count_if(F.col("cached")).alias("cached"),
        F.round(F.count_if(F.col("cached")) / F.count(F.lit(1)), 4).alias("hit_rate"),
        total("retries").alias("retries"),
        F.round(F.coalesce(F.sum(F.col("estimated_cost_usd").cast("decimal(28,8)")), F.lit(0)), 6)
        .cast("double")
        .alias("cost_usd"),
        F.when(F.count("estimated_cost_usd") > 0, "configured").otherwise("not configured").alias("cost_status"),
    )


def failure_summary(failures: DataFrame, *, limit: int | None = None) -> DataFrame:
    return (
        failures.groupBy("stage", "error_type")
        .agg(F.count(F.lit(1)).alias("failures"))
        .orderBy(F.desc("failures"), "stage", "error_type")
        .transform(_top, limit)
    )


def task_failures(enriched: DataFrame, *, max_message: int | None = None) -> DataFrame:
    """One row per failure kept inside an enrichment, with defaults for what it lacks."""
    rows = enriched.select(*PLACE, "title", F.explode("failures").alias("f"))
    context = F.col("f.error_context")

    def said(*options: Column) -> Column:
        return F.coalesce(*[F.nullif(o, F.lit("")) for o in options], F.lit("unknown"))

    return rows.select(
        *PLACE, "title",
        said(context["task"], F.col("f.stage")).alias("task"),
        said(context["provider"]).alias("provider"),
        said(context["model"]).alias("model"),
        said(context["prompt_version"]).alias("prompt_version"),
        said(F.col("f.error_type")).alias("error_type"),
        tx.head(F.coalesce("f.message", F.lit("")), max_message).alias("message"),
        F.lit("deterministic_fallback_retained").alias("fallback"),
    )


def failures_without_document(failures: DataFrame, index: DataFrame) -> DataFrame:
    return failures.join(index.select("page_id"), "page_id", "left_anti")


# ---- images ----------------------------------------------------------------------------------

PAGE_STATUSES = ["complete", "partial", "skipped", "failed"]
IMAGE_STATUSES = ["success", "skipped", "failed"]


def _status_is(status: str):
    return lambda image: image["status"] == status


def visual_status_counts(artifacts: DataFrame) -> DataFrame:
    """(scope, status, n) with zeros for statuses that do not occur."""
    listed = F.size("images") > 0
    pieces = [
        F.struct(F.lit("page").alias("scope"), F.col("status").alias("status"), F.lit(1).cast("bigint").alias("n"))
    ]
    stored = {"success": "images_succeeded", "skipped": "images_skipped", "failed": "images_failed"}
    for status in IMAGE_STATUSES:
        count = F.when(listed, F.size(F.filter("images", _status_is(status)))).otherwise(F.col(stored[status]))
        pieces.append(
            F.struct(F.lit("image").alias("scope"), F.lit(status).alias("status"), count.cast("bigint").alias("n"))
        )
    counted = (
        artifacts.select(F.explode(F.array(*pieces)).alias("p")).groupBy("p.scope", "p.status").agg(F.sum("p.n").alias("n"))
    )
    spark = artifacts.sparkSession
    fixed = spark.createDataFrame(
        [("page", s) for s in PAGE_STATUSES] + [("image", s) for s in IMAGE_STATUSES], "scope string, status string"
    )
    return fixed.join(counted, ["scope", "status"], "left").select(
        "scope", "status", F.coalesce("n", F.lit(0)).alias("n")
    )


def visual_images(artifacts: DataFrame) -> DataFrame:
    """The exploded image table of the artifacts."""
    return artifacts.select(*PLACE, F.posexplode("images").alias("pos", "i")).select(*PLACE, "pos", "i.*")


def source_host(source: Column) -> Column:
    """Host of a URL, else its scheme, else ``unknown``."""
    host = F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)
    scheme = F.regexp_extract(source, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    return F.lower(F.coalesce(F.nullif(host, F.lit("")), F.nullif(scheme, F.lit("")), F.lit("unknown")))


def visual_remote_skips(artifacts: DataFrame) -> DataFrame:
    return (
        visual_images(artifacts)
        .where("status = 'skipped' and error_type = 'remote_source_not_in_cache'")
        .groupBy(source_host(F.col("source")).alias("host"), "source_kind", "error_type")
        .agg(F.count(F.lit(1)).alias("images"))
    )


def visual_duplicates(artifacts: DataFrame, *, listed: int = 12, sources: int = 4) -> DataFrame:
    """Image hashes on at least two images with the first samples in (space, page, position) order."""
    from pyspark.sql import Window

    images = visual_images(artifacts).where("content_sha256 <> ''")
    sizes = images.groupBy("content_sha256").agg(F.count(F.lit(1)).alias("images")).where("images > 1")
    order = Window.partitionBy("content_sha256").orderBy(*PLACE, "pos")
    head = images.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= listed)
    samples = head.groupBy("content_sha256").agg(
        F.array_sort(
            F.collect_list(F.struct("rn", F.concat_ws(":", *PLACE, "image_id").alias("where"), "source"))
        ).alias("s")
    )
    return sizes.join(samples, "content_sha256").select(
        "content_sha256", "images", F.array_join("s.where", ", ").alias("samples"),
        F.array_join(F.slice("s.source", 1, sources), ", ").alias("sources"),
    )


def visual_coverage(artifacts: DataFrame, total_pages: DataFrame) -> DataFrame:
    """One row: pages, pages with and without artifacts, images discovered and stored."""
    stored = F.when(F.size("images") > 0, F.size("images")).otherwise(
        F.col("images_succeeded") + F.col("images_skipped") + F.col("images_failed")
    )
    found = artifacts.agg(
        F.count(F.lit(1)).alias("pages_with_artifacts"),
        F.coalesce(F.sum("discovered"), F.lit(0)).alias("images_discovered"),
        F.coalesce(F.sum(stored), F.lit(0)).alias("images_in_artifacts"),
    )
    pages = total_pages.agg(F.count(F.lit(1)).alias("pages"))
    both = pages.withColumn("_k", F.lit(1)).join(found.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return both.withColumn(
        "pages_without_artifacts", F.greatest(F.col("pages") - F.col("pages_with_artifacts"), F.lit(0))
    )


def _processed() -> Column:
    return F.when(F.col("image_count") > 0, F.col("image_count")).otherwise(F.size("images"))


def visual_capped(artifacts: DataFrame, *, limit: int | None = None) -> DataFrame:
    rows = (
        artifacts.withColumn("processed", _processed())
        .withColumn("omitted", F.greatest(F.col("discovered") - F.col("processed"), F.lit(0)))
        .where("omitted > 0")
        .orderBy(F.desc("omitted"), *PLACE)
        .select(*PLACE, "discovered", "processed", "omitted")
    )
    return _top(rows, limit)


def visual_failed(artifacts: DataFrame, *, limit: int | None = None) -> DataFrame:
    return (
        visual_images(artifacts)
        .where("status = 'failed'")
        .orderBy(*PLACE, "image_id")
        .transform(_top, limit)
        .select(*PLACE, "image_id", F.coalesce("error_type", F.lit("unknown")).alias("error_type"), "source_kind", "source")
    )


def visual_low_confidence(artifacts: DataFrame, *, threshold: float = 0.75, limit: int | None = None) -> DataFrame:
    return (
        visual_images(artifacts)
        .where((F.col("status") == "success") & (F.col("confidence") < threshold))
        .orderBy("confidence", *PLACE, "pos")
        .transform(_top, limit)
        .select("confidence", *PLACE, "image_id", "source_kind", "source")
    )


def visual_high_value_omitted(
    artifacts: DataFrame, index: DataFrame, quality: DataFrame, *, limit: int | None = None
) -> DataFrame:
    """Capped pages that matter: high review priority, or a runbook or support model."""
    capped = visual_capped(artifacts, limit=None)
    ranked = quality_lookup(index, quality).withColumn("priority", review_priority())
    return (
        capped.join(ranked.drop("space_key"), "page_id")
        .where((F.col("priority") >= 80) | F.col("document_type").isin("runbook", "support_model"))
        .orderBy(F.desc("priority"), F.desc("omitted"), *PLACE)
        .transform(_top, limit)
        .select(
            "priority", *PLACE, "document_type", F.coalesce("document_subtype", F.lit("")).alias("document_subtype"),
            "quality", "discovered", "processed", "omitted", "title", "url",
        )
    )


def page_visual_status(images: DataFrame) -> DataFrame:
    """(document_id, counts, status) from the image rows of a page."""
    def n(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    total = F.count(F.lit(1))
    return images.groupBy("document_id").agg(
        total.alias("image_count"),
        n("success").alias("images_succeeded"),
        n("failed").alias("images_failed"),
        n("skipped").alias("images_skipped"),
    ).withColumn(
        "status",
        F.when(F.col("images_succeeded") == F.col("image_count"), "complete")
        .when(F.col("images_succeeded") > 0, "partial")
        .when(F.col("images_skipped") == F.col("image_count"), "skipped")
        .otherwise("failed"),
    )


# ---- text form -------------------------------------------------------------------------------


def markdown_rows(report: DataFrame) -> DataFrame:
    """One Markdown table row per report row; line breaks in cells become blanks."""
    cells = [
        F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("\n"), F.lit(" ")) for c in report.columns
    ]
    return report.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))


def markdown_header(report: DataFrame) -> list[str]:
    return ["| " + " | ".join(report.columns) + " |", "| " + " | ".join("---" for _ in report.columns) + " |"]


def cost_rates(usage: DataFrame, rates: DataFrame) -> DataFrame:
    """Add ``estimated_cost_usd``: rate by ``provider:model``, then model, then provider.

    The first rate *entry* that exists decides; an entry lacking a rate gives null.
    """
    table = broadcast_if_small(
        rates.select(F.col("key").alias("_key"), F.struct("input", "output").alias("_rate"))
    )
    df = usage
    for n, key in enumerate(
        [F.concat(F.col("provider"), F.lit(":"), F.col("model")), F.col("model"), F.col("provider")]
    ):
        renamed = table.select(F.col("_key").alias(f"_k{n}"), F.col("_rate").alias(f"_r{n}"))
        df = df.withColumn(f"_q{n}", key).join(renamed, F.col(f"_q{n}") == F.col(f"_k{n}"), "left")
    rate = F.coalesce("_r0", "_r1", "_r2")
    cost = F.coalesce("input_tokens", F.lit(0)) / 1000 * rate["input"] + F.coalesce(
        "output_tokens", F.lit(0)
    ) / 1000 * rate["output"]
    return df.withColumn("estimated_cost_usd", F.round(cost, 8)).drop(
        *[f"_{p}{n}" for p in "qkr" for n in range(3)]
    )

