"""Text export: who may be exported, link ranking, rendered text, audit of exported files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx


def _lits(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def export_eligibility(
    enriched: DataFrame, *, audiences=(), sensitivities=(), availability=(), review_flags=()
) -> DataFrame:
    """Add ``exclusion_reasons`` and ``eligible``."""
    def named(column: str, excluded) -> Column:
        return F.when(F.col(column).isin(list(excluded)), F.concat(F.lit(f"{_LABELS[column]}:"), F.col(column)))

    plain = F.array_compact(
        F.array(
            named("audience", audiences),
            named("sensitivity", sensitivities),
            named("content_availability", availability),
        )
    )
    flags = F.array_sort(F.array_intersect("review_flags", _lits(review_flags)))
    reasons = F.concat(plain, F.transform(flags, lambda f: F.concat(F.lit("review_flag:"), f)))
    return enriched.withColumn("exclusion_reasons", reasons).withColumn(
        "eligible", F.size("exclusion_reasons") == 0
    )


_LABELS = {"audience": "audience", "sensitivity": "sensitivity", "content_availability": "content_availability"}


# ---- links -----------------------------------------------------------------------------------


def low_value_link(text: Column, href: Column) -> Column:
    """Mail, anchors, version diffs, templates, personal pages."""
    said = F.lower(F.concat(F.coalesce(text, F.lit("")), F.lit(" "), href))
    return href.startswith("mailto:") | href.startswith("#") | tx.contains_any(said, fv.LOW_VALUE_LINK_TERMS)


def low_value_links(pages: DataFrame) -> DataFrame:
    """(document_id, href, text, low_value) of every link with a target."""
    links = pages.select("document_id", F.explode("links").alias("l")).select("document_id", "l.href", "l.text")
    return links.where(F.coalesce("href", F.lit("")) != "").withColumn(
        "low_value", low_value_link(F.col("text"), F.col("href"))
    )


def source_link_ranking(
    pages: DataFrame, *, early: int = 8, additional: int | None = None, wiki_word: str = "wiki"
) -> DataFrame:
    """(document_id, section, position, label, href): the links shown first and all links.

    Section ``early`` lists the best ``early`` useful links, ``additional`` all links of any value, or the best
    ``additional`` of them; both skip anchors and repeat no target.
    """
    raw = pages.select("document_id", F.posexplode("links").alias("pos", "l")).select(
        "document_id", "pos", F.coalesce("l.text", F.lit("")).alias("text"),
        F.coalesce("l.href", F.lit("")).alias("href"), F.col("l.target_title").alias("target_title"),
    )
    said = F.lower(F.concat("text", F.lit(" "), "href"))
    rank = F.when(low_value_link(F.col("text"), F.col("href")), 5)
    for value, terms in fv.LINK_RANK_TERMS:
        rank = rank.when(tx.contains_any(said, terms), value)
    rank = rank.when(said.contains(wiki_word), 2).otherwise(3)
    per_doc = Window.partitionBy("document_id")
    ranked = (
        raw.withColumns({"_rank": rank, "_said": said})
        .repartition("document_id")
        .withColumn("_index", F.row_number().over(per_doc.orderBy("_rank", "_said", "pos")))
        .where((F.col("href") != "") & ~F.col("href").startswith("#"))
    )
    said_label = tx.strip(
        F.coalesce(
            F.nullif("text", F.lit("")), F.nullif("target_title", F.lit("")),
            F.concat(F.lit("Source link "), F.col("_index").cast("string")),
        )
    )
    label = F.when(
        F.lower(said_label).isin("here", "link", "click here"),
        F.concat(F.lit("Referenced source link "), F.col("_index").cast("string")),
    ).otherwise(said_label)

    def section(name: str, rows: DataFrame, limit: int | None) -> DataFrame:
        first = Window.partitionBy("document_id", "href").orderBy("_index")
        once = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1")
        placed = once.withColumn("position", F.row_number().over(per_doc.orderBy("_index")))
        if limit is not None:
            placed = placed.where(F.col("position") <= limit)
        return placed.select("document_id", F.lit(name).alias("section"), "position", label.alias("label"), "href")

    useful = ranked.where(F.col("_rank") != 5)
    return section("early", useful, early).unionByName(section("additional", ranked, additional))


def link_lines(ranking: DataFrame) -> DataFrame:
    """(document_id, early_links, additional_links) as Markdown lines."""
    line = F.concat(F.lit("- "), "label", F.lit(": "), "href")

    def joined(section: str) -> Column:
        rows = F.collect_list(F.when(F.col("section") == section, F.struct("position", line.alias("line"))))
        return F.array_join(F.transform(F.array_sort(rows), lambda r: r["line"]), "\n")

    return ranking.groupBy("document_id").agg(
        joined("early").alias("early_links"), joined("additional").alias("additional_links")
    )


# ---- rendering -------------------------------------------------------------------------------


def export_metadata(
    enriched: DataFrame, *, dataset_name: str, source_system: str = "wiki", prefix: str = "#DOCUMENT_METADATA="
) -> DataFrame:
    """Add ``metadata_line``: the JSON (sorted keys, nulls dropped) that starts an exported text."""
    fields = {
        "approval_status": F.lit("unreviewed"),
        "audience": F.col("audience"),
        "content_availability": F.col("content_availability"),
        "currentness": F.col("currentness"),
        "dataset_name": F.lit(dataset_name),
        "doc_updated_at": F.coalesce("updated_at", F.lit("")),
        "document_subtype": F.col("document_subtype"),
        "document_type": F.col("document_type"),
        "file_display_name": F.col("title"),
        "historical": F.col("historical"),
        "link": F.coalesce("url", F.lit("")),
        "quality_band": F.col("quality_band"),
        "review_flags": F.col("review_flags"),
        "sensitivity": F.col("sensitivity"),
        "source_system": F.lit(source_system),
        "space_key": F.col("space_key"),
    }
    packed = F.to_json(F.struct(*[c.alias(n) for n, c in sorted(fields.items())]))
    return enriched.withColumn("metadata_line", F.concat(F.lit(prefix), packed))


def _question(value: Column) -> Column:
    low = F.lower(tx.strip(value))
    hit = value.contains("?")
    for start in fv.QUESTION_STARTS:
        hit = hit | low.startswith(start)
    return hit


def _noisy_value(value: Column) -> Column:
    return (F.length(value) > 100) | F.lower(tx.strip(value)).isin(fv.KEY_FACT_GENERIC)


def key_fact_values(values: Column, *, support: bool = False, limit: int | None = None) -> Column:
    """Names worth a key-fact line: no generic ones, questions or repeats; teams must look like one."""
    def good(v: Column) -> Column:
        ok = (tx.strip(v) != "") & ~F.lower(tx.strip(v)).isin(fv.EXPORT_GENERIC_NAMES) & ~_question(v) & ~_noisy_value(v)
        return ok & tx.contains_any(F.lower(v), fv.STABLE_SUPPORT_TERMS) if support else ok

    return tx.first_by_key(F.filter(values, good), lambda v: F.lower(tx.strip(v)), limit)


def key_facts_lines(df: DataFrame, *, max_values: int | None = None) -> DataFrame:
    """Add ``key_facts_text``. Uses the enrichment columns, the entity name lists and key facts if present.

    ``max_values`` bounds the names, terms, attachments and key facts of a line or list; all are told without it.
    """
    shown = tx.display_title(F.col("title"))

    def line(label: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"- {label}: "), value)
        return text if when is None else F.when(when, text)

    def names(label: str, column: str, support: bool = False) -> Column:
        if column not in df.columns:
            return F.lit(None).cast("string")
        kept = key_fact_values(F.col(column), support=support, limit=max_values)
        return F.when(F.size(kept) > 0, F.concat(F.lit(f"- {label}: "), F.array_join(kept, ", ")))

    def signal(name: str, label: str) -> Column:
        return F.when(F.col(f"signals.{name}"), F.lit(f"- {label} signal: present"))

    terms = tx.first(F.filter("keywords", lambda k: ~F.lower(k).isin(fv.KEY_FACT_GENERIC)), max_values)
    told = F.array().cast("array<string>")
    if "key_facts" in df.columns:
        good = F.filter(
            tx.first(tx.coalesce_array(F.col("key_facts"), "struct<label:string,value:string,confidence:double,evidence:string>"), max_values),
            lambda f: (tx.strip(f["label"]) != "") & (tx.strip(f["value"]) != "") & ~_question(f["value"]) & ~_noisy_value(f["value"]),
        )
        listed = F.transform(good, lambda f: F.concat(F.lit("- "), tx.strip(f["label"]), F.lit(": "), tx.strip(f["value"])))
        told = tx.first_by_key(listed, lambda v: F.lower(v))
    fixed = F.array_compact(
        F.array(
            line("Page title", shown),
            line("Original source title", F.col("title"), shown != F.col("title")),
            line("Source space", F.col("space_key")),
            line("Parent section", F.col("parent_title"), F.coalesce("parent_title", F.lit("")) != ""),
            line("Section path", F.col("section_path"), F.col("section_path") != ""),
            line("Page role", F.col("page_role")),
            line("Parent context", F.col("parent_context_type"), F.col("parent_context_type").isNotNull()),
            line("Document type", F.col("document_type")),
            line("Document subtype", F.col("document_subtype"), F.col("document_subtype").isNotNull()),
            line("Content availability", F.col("content_availability")),
            line("Currentness", F.col("currentness")),
            line("Source updated at", F.col("updated_at"), F.coalesce("updated_at", F.lit("")) != ""),
            names("Applications", "applications"),
            names("Databases", "databases"),
            names("Queues", "queues"),
            names("Dashboards", "dashboards"),
            names("Support groups", "support_groups", support=True),
            names("Teams", "teams", support=True),
            F.when(F.size(terms) > 0, F.concat(F.lit("- Important terms: "), F.array_join(terms, ", "))),
            signal("has_owner", "Owner"),
            signal("has_support_group", "Support group"),
            signal("has_dependencies", "Dependency"),
            signal("has_recovery_steps", "Recovery/failover"),
            F.when(
                F.size("referenced_attachment_names") > 0,
                F.concat(F.lit("- Attachments: "), F.array_join(tx.first(F.col("referenced_attachment_names"), max_values), ", ")),
            ),
        )
    )
    return df.withColumn("key_facts_text", F.array_join(F.concat(told, fixed), "\n"))


def display_entities(entities: DataFrame, *, limit: int | None = None) -> DataFrame:
    """(document_id, entity_lines): model entities first, then confident ones, generic names dropped; all unless limited."""
    by_model = F.col("method") == "llm"
    kept = entities.where(
        ~F.lower("normalized_name").isin(fv.EXPORT_GENERIC_NAMES) & (by_model | (F.col("confidence") >= 0.7))
    )
    order = Window.partitionBy("document_id").orderBy(
        (~by_model).cast("int"), F.desc("confidence"), "entity_type", F.lower("name")
    )
    line = F.concat(
        F.lit("- "), "name", F.lit(" ("), "entity_type", F.lit(", confidence "),
        F.format_string("%.2f", "confidence"), F.lit(")"),
    )
    placed = kept.withColumn("_n", F.row_number().over(order))
    if limit is not None:
        placed = placed.where(F.col("_n") <= limit)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("_n", line.alias("line")))), lambda r: r["line"])
    return placed.groupBy("document_id").agg(F.array_join(lines, "\n").alias("entity_lines"))


def export_path(dataset_name: str, *, slug_max_chars: int = 90) -> Column:
    return F.concat_ws(
        "/", F.lit(dataset_name), "space_key",
        F.concat("page_id", F.lit("-"), tx.slugify(F.col("title"), slug_max_chars), F.lit(".md")),
    )


def source_section(markdown: Column, *, max_chars: int | None = None) -> tuple[Column, Column]:
    """(source text with image notes, its first ``max_chars`` characters if given; how many characters that leaves out)."""
    body = tx.rewrite_images(tx.strip_front_matter(markdown))
    left_out = F.lit(0) if max_chars is None else F.greatest(F.length(body) - max_chars, F.lit(0))
    return tx.head(body, max_chars), left_out


def render_documents(
    enriched: DataFrame,
    pages: DataFrame,
    *,
    dataset_name: str,
    entity_lines: DataFrame | None = None,
    links: DataFrame | None = None,
    visuals: DataFrame | None = None,
    max_chars: int | None = None,
    slug_max_chars: int = 90,
    run_id: str = "",
) -> DataFrame:
    """(document_id, space_key, page_id, title, path, content, render_warnings) of eligible pages.

    ``enriched`` holds the slim columns of eligible pages; the body text is joined in last, once,
    for those pages only. Nothing is redacted here: ``plans.export`` does that on the finished text.
    """
    df = key_facts_lines(export_metadata(enriched, dataset_name=dataset_name))
    for part in (entity_lines, links, visuals):
        if part is not None:
            df = df.join(part, "document_id", "left")
    body = pages.select("document_id", "markdown").join(
        enriched.select("document_id"), "document_id", "left_semi"
    )
    df = df.join(body, "document_id")
    source, left_out = source_section(F.col("markdown"), max_chars=max_chars)

    def bullets(column: str) -> Column:
        c = F.col(column)
        return F.when(
            F.size(c) > 0, F.array_join(F.transform(c, lambda v: F.concat(F.lit("- "), v)), "\n")
        ).otherwise(F.lit("- none"))

    def optional(column: str) -> Column:
        return F.coalesce(column, F.lit("")) if column in df.columns else F.lit("")

    def or_none(c: Column) -> Column:
        return F.when(c == "", F.lit("- none")).otherwise(c)

    def tick(c) -> Column:
        return F.concat(F.lit("`"), c, F.lit("`"))

    q = F.col("quality")
    flags = F.when(F.size("review_flags") > 0, F.array_join("review_flags", ", ")).otherwise(F.lit("none"))
    later = optional("additional_links")
    sections = [
        F.concat(F.lit("# "), tx.display_title(F.col("title"))),
        F.lit("> Enriched from a source document. Not approved curated knowledge."),
        F.lit("## Answer Summary"),
        F.col("short_summary"),
        F.col("detailed_summary"),
        F.concat_ws(
            "\n",
            F.concat(F.lit("Document type: "), tick(F.col("document_type")), F.format_string(" (%.2f)", "document_type_confidence")),
            F.concat(F.lit("Document subtype: "), tick(F.coalesce("document_subtype", F.lit("not classified")))),
            F.concat(F.lit("Content availability: "), tick(F.col("content_availability"))),
            F.concat(F.lit("Quality band: "), tick(F.col("quality_band")), F.format_string(" (%d/100)", q["overall_score"])),
            F.concat(F.lit("Currentness: "), tick(F.col("currentness"))),
            F.concat(F.lit("Audience: "), tick(F.col("audience"))),
            F.concat(F.lit("Sensitivity: "), tick(F.col("sensitivity"))),
        ),
        F.concat(F.lit("Review flags: "), tick(flags)),
        F.lit("## Key Facts"),
        or_none(F.col("key_facts_text")),
        F.lit("## Source Links"),
        or_none(optional("early_links")),
        F.lit("## Source Content"),
        source,
        F.nullif(optional("visual_text"), F.lit("")),
        F.when(
            (later != "") & (later != optional("early_links")), F.concat(F.lit("## Additional Source Links\n\n"), later)
        ),
        F.lit("## Keywords"), bullets("keywords"),
        F.lit("## Themes"), bullets("themes"),
        F.lit("## Concepts"), bullets("concepts"),
        F.lit("## Candidate Entities"), or_none(optional("entity_lines")),
        F.lit("## Quality Signals"),
        F.format_string(
            "- Freshness: %d\n- Authority: %d\n- Completeness: %d\n- Operational value: %d\n- Ownership clarity: %d",
            q["freshness_score"], q["authority_score"], q["completeness_score"], q["operational_value_score"],
            q["ownership_clarity_score"],
        ),
        F.lit("## Review Flags"), bullets("review_flags"),
        F.concat(
            F.when(F.col("document_type").isin("runbook", "support_model"), "Operational Gaps").otherwise("Documentation Quality Notes"),
            F.lit(":\n\n"), bullets("warnings"),
        ),
        F.lit("## Source Metadata"),
        F.concat_ws(
            "\n",
            F.lit(f"Run ID: {run_id}"),
            F.concat(F.lit("Document ID: "), "document_id"),
            F.concat(F.lit("Page ID: "), "page_id"),
            F.concat(F.lit("Space: "), "space_key"),
            F.concat(F.lit("Source updated at: "), F.coalesce("updated_at", F.lit("unknown"))),
            F.concat(F.lit("Source content hash: "), "source_content_hash"),
            F.concat(F.lit("Source URL: "), F.coalesce("url", F.lit("unknown"))),
            F.concat(F.lit("Attachment count: "), F.col("attachment_count").cast("string")),
            F.concat(F.lit("Missing attachment content count: "), F.size("missing_attachment_names").cast("string")),
            F.concat(F.lit("Hierarchy depth: "), F.col("depth").cast("string")),
            F.concat(F.lit("Parent section: "), F.coalesce("parent_title", F.lit("none"))),
            F.concat(F.lit("Page role: "), "page_role"),
            F.concat(F.lit("Section path: "), "section_path"),
        ),
    ]
    return df.select(
        "document_id", "space_key", "page_id", "title",
        export_path(dataset_name, slug_max_chars=slug_max_chars).alias("path"),
        F.concat_ws("\n\n", F.col("metadata_line"), *sections).alias("content"),
        F.when(left_out > 0, F.array(F.concat(F.lit("source_content_left_out:"), left_out.cast("string")))).otherwise(F.array().cast("array<string>")).alias("render_warnings"),
    )


# ---- audit -----------------------------------------------------------------------------------


def export_audit(files: DataFrame, index: DataFrame) -> DataFrame:
    """(path, page_id, state): current, duplicate, stale or unparseable; nothing is deleted.

    ``files`` has ``path`` and ``modified`` (any ordered type). Of several files of one page the
    newest, then the largest path, is current. ``to_remove`` marks stale and duplicate files.
    """
    name = F.substring_index("path", "/", -1)
    parsed = files.withColumn("page_id", F.nullif(F.regexp_extract(name, r"^(\d+)-.+\.md$", 1), F.lit("")))
    known = index.select("page_id").distinct().withColumn("_known", F.lit(True))
    newest = Window.partitionBy("page_id").orderBy(F.desc("modified"), F.desc("path"))
    good = (
        parsed.where(F.col("page_id").isNotNull())
        .join(known, "page_id", "left")
        .withColumn("_n", F.row_number().over(newest))
        .withColumn(
            "state",
            F.when(F.col("_known").isNull(), "stale").when(F.col("_n") > 1, "duplicate").otherwise("current"),
        )
        .select("path", "page_id", "state")
    )
    bad = parsed.where(F.col("page_id").isNull()).select("path", "page_id", F.lit("unparseable").alias("state"))
    return good.unionByName(bad).withColumn("to_remove", F.col("state").isin("stale", "duplicate"))
