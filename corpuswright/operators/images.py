"""Images of pages: discovery, scoring, selection under caps, reuse by content hash, extraction."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx
from corpuswright.operators.hierarchy import ancestor_titles
from corpuswright.session import broadcast_if_small, cut_lineage, salted_join

IMAGE_REF = r"!\[[^\]]*\]\(([^)\s]+)(?:\s+\"[^\"]*\")?\)"
PAGE_FILE_URL = r"(?:^|/)download/attachments/(\d+)/([^/?#]+)"
SUFFIX = "(?i)(?:" + "|".join(s.replace(".", r"\.") for s in fv.IMAGE_SUFFIXES) + ")$"


def heading_text(line: Column) -> Column:
    """Text of a line that starts with ``#``, null for other lines."""
    bare = tx.strip(line)
    return F.when(bare.startswith("#"), tx.strip(F.regexp_replace(bare, "^#+", "")))


def image_lines(pages: DataFrame) -> DataFrame:
    """One row per line with an image: the line, its neighbours and the heading before it.

    A page's lines are looked at once, inside its own row. Only lines with an image or a heading leave it, each image
    line with the one before and after it; the heading is the last one of the lines before, found by one running pass.
    """
    ids = ["document_id", "page_id", "space_key"]
    lined = pages.where(F.col("markdown").contains("](")).select(*ids, F.split("markdown", "\n").alias("_lines"))

    def event(line: Column, i: Column) -> Column:
        image = line.rlike(IMAGE_REF)
        around = F.concat_ws("\n", F.get("_lines", i - 1), line, F.get("_lines", i + 1))
        return F.struct(
            i.alias("line"), F.when(image, line).alias("text"), F.when(image, around).alias("context"),
            heading_text(line).alias("heading"),
        )

    events = F.filter(F.transform("_lines", event), lambda e: e["text"].isNotNull() | e["heading"].isNotNull())
    rows = lined.select(*ids, F.explode(events).alias("e")).select(*ids, "e.*")
    above = Window.partitionBy(*ids).orderBy("line").rangeBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("above", F.last("heading", ignorenulls=True).over(above)).where("text is not null")


def image_references(pages: DataFrame) -> DataFrame:
    """One row per Markdown image: raw source, running number, heading before it, lines around it.

    A heading in the image's own line counts up to the image.
    """
    refs = F.regexp_extract_all("text", F.lit(IMAGE_REF), 0)
    rows = image_lines(pages).select("*", F.posexplode(refs).alias("in_line", "ref"))
    prefix = F.substring(F.col("text"), F.lit(1), F.position(F.col("ref"), F.col("text")) - 1)
    return rows.select(
        "document_id", "page_id", "space_key", "line", "in_line",
        F.trim(F.regexp_extract("ref", IMAGE_REF, 1), F.lit("<>")).alias("raw"),
        F.nullif(F.coalesce(heading_text(prefix), "above"), F.lit("")).alias("nearby_heading"),
        "context",
    )


def _path(source: Column) -> Column:
    """Path part of a URL or of a plain reference."""
    bare = F.regexp_replace(source, r"[?#].*$", "")
    return F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")


def _unquote(c: Column) -> Column:
    return F.when(c.contains("%"), F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)).otherwise(c)


def skip_reference(source: Column) -> Column:
    """Templates, icons, and local references that are not image files."""
    path = F.lower(_unquote(_path(source)))
    remote = F.lower(source).rlike(r"^(https?|data|file):")
    icon = ~F.lower(source).startswith("data:") & path.contains("/images/icons/")
    return (source == "") | source.startswith("$") | icon | (~remote & ~_unquote(source).rlike(SUFFIX))


def mime_type(name: Column) -> Column:
    suffix = F.lower(F.regexp_extract(name, r"\.([A-Za-z]+)$", 1))
    return F.when(suffix.isin("jpg", "jpeg"), "image/jpeg").when(
        suffix.isin("gif", "png", "webp"), F.concat(F.lit("image/"), suffix)
    )


def resolve_image_refs(refs: DataFrame, attachments: DataFrame) -> DataFrame:
    """Replace image URLs by the attachment they name; add ``source``, ``source_kind``, ``mime_type``.

    Looked up in the page's own attachments, then in those of the page named in the URL; an exact
    file name is preferred to one that differs in case. ``attachments`` has page_id and name.
    """
    web = F.lower("raw").rlike("^https?://")
    named = refs.withColumns(
        {
            "_file": F.when(web, F.substring_index(_unquote(_path(F.col("raw"))), "/", -1)),
            "_page2": F.when(web, F.nullif(F.regexp_extract(_unquote(_path(F.col("raw"))), PAGE_FILE_URL, 1), F.lit(""))),
        }
    ).withColumn("_low", F.lower("_file"))
    known = attachments.select(
        F.col("page_id").alias("_p"), F.lower("name").alias("_l"), F.col("name").alias("_name")
    )
    # names differing only in case are few; keep them together so the exact one can be preferred
    folded = known.groupBy("_p", "_l").agg(F.array_sort(F.collect_set("_name")).alias("_names"))

    def found(names: Column) -> Column:
        return F.when(F.array_contains(names, F.col("_file")), F.col("_file")).otherwise(F.element_at(names, 1))

    own = folded.withColumnsRenamed({"_names": "_own"})
    other = folded.withColumnsRenamed({"_p": "_p2", "_l": "_l2", "_names": "_other"})
    joined = (
        named.join(own, (F.col("page_id") == F.col("_p")) & (F.col("_low") == F.col("_l")), "left")
        .join(other, (F.col("_page2") == F.col("_p2")) & (F.col("_low") == F.col("_l2")), "left")
    )
    local = F.coalesce(
        F.when(F.col("_own").isNotNull(), F.concat_ws("/", "page_id", F.lit("attachments"), found(F.col("_own")))),
        F.when(F.col("_other").isNotNull(), F.concat_ws("/", "_page2", F.lit("attachments"), found(F.col("_other")))),
    )
    data = F.lower("raw").startswith("data:")
    plain = F.regexp_replace(_unquote(F.col("raw")), r"^(?:\./)+", "")
    file_path = F.when(plain.startswith("/"), plain).otherwise(F.concat_ws("/", "page_id", plain))
    source = F.when(data, F.col("raw")).when(web, F.coalesce("_local", "raw")).otherwise(file_path)
    kind = F.when(data, "data_url").when(web & F.col("_local").isNull(), "url").otherwise("file")
    return (
        joined.withColumn("_local", local)
        .withColumns({"source": source, "source_kind": kind})
        .withColumn(
            "mime_type",
            F.when(data, F.nullif(F.regexp_extract("raw", r"^[dD][aA][tT][aA]:([^;]*)", 1), F.lit(""))).otherwise(
                mime_type(_path(F.col("source")))
            ),
        )
        .select(*refs.columns, "source", "source_kind", "mime_type")
    )


def discover_images(pages: DataFrame, attachments: DataFrame) -> DataFrame:
    """All candidate images of a page, numbered: Markdown references, then further image attachments."""
    refs = image_references(pages).where(~skip_reference(F.col("raw")))
    told = resolve_image_refs(refs, attachments).withColumn("_group", F.lit(0))
    files = (
        attachments.where(F.col("name").rlike(SUFFIX))
        .join(pages.select("document_id", "page_id", "space_key"), "page_id")
        .select(
            "document_id", "page_id", "space_key", F.lit(0).alias("line"), F.lit(0).alias("in_line"),
            F.col("name").alias("raw"), F.lit(None).cast("string").alias("nearby_heading"),
            F.col("name").alias("context"),
            F.concat_ws("/", "page_id", F.lit("attachments"), "name").alias("source"),
            F.lit("file").alias("source_kind"), mime_type(F.col("name")).alias("mime_type"),
            F.lit(1).alias("_group"),
        )
    )
    both = told.unionByName(files).repartition("document_id")
    order = ["_group", "line", "in_line", "source"]
    first = Window.partitionBy("document_id", "source").orderBy(*order)
    number = Window.partitionBy("document_id").orderBy(*order)
    return (
        both.withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
        .withColumn("source_order", F.row_number().over(number))
        .select(
            "document_id", "page_id", "space_key", "source_order", "source", "source_kind", "mime_type",
            "nearby_heading", "context",
        )
    )


def page_facts(pages: DataFrame) -> DataFrame:
    """(document_id, few_words, report_like): what selection needs to know of a page."""
    words = tx.token_count(F.col("text"))
    named = F.lower(
        F.concat_ws(" ", F.col("title"), F.array_join("labels", " "), F.array_join(ancestor_titles(F.col("ancestors")), " "))
    )
    return pages.select(
        "document_id", ((words > 0) & (words < 150)).alias("few_words"), named.rlike(fv.REPORT_WORDS).alias("report_like")
    )


def _said() -> Column:
    parts = F.array_compact(
        F.array(*[F.nullif(F.coalesce(F.col(c), F.lit("")), F.lit("")) for c in ("source", "nearby_heading", "context")])
    )
    return F.lower(F.array_join(parts, " "))


def score_images(images: DataFrame, facts: DataFrame) -> DataFrame:
    """Add ``selection_score``, ``selection_reasons``, ``few_words`` and ``report_like``."""
    df = images.join(facts, "document_id", "left").withColumn("_said", _said())
    rules = [(F.col("context") != "", 20, "markdown_reference")]
    rules += [(F.col("_said").rlike(p), 25, name) for name, p in fv.IMAGE_TOPICS.items()]
    rules += [
        (F.coalesce("few_words", F.lit(False)), 15, "low_text_page"),
        (F.col("_said").rlike(fv.IMAGE_LOW_VALUE), -35, "likely_low_value_visual"),
        (F.col("source_kind") == "url", -20, "remote_not_local"),
    ]
    score = F.lit(10)
    for when, points, _ in rules:
        score = score + F.when(when, points).otherwise(0)
    reasons = F.array_compact(F.array(*[F.when(when, name) for when, _, name in rules]))
    return df.withColumns(
        {
            "selection_score": score,
            "selection_reasons": F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("default_order"))),
        }
    ).drop("_said")


def image_group_keys(scored: DataFrame, *, sampling: bool = True) -> DataFrame:
    """Add ``group_key`` of look-alike images (report pages and dashboard-like images only)."""
    if not sampling:
        return scored.withColumn("group_key", F.lit(None).cast("string"))
    said = _said()
    masked = F.regexp_replace(said, r"\b\d{1,4}[-_:./]?\d{0,4}[-_:./]?\d{0,4}\b", "#")
    masked = F.regexp_replace(masked, r"image[-_. ]*#", "image")
    words = F.split(F.trim(F.regexp_replace(masked, r"[^a-z#]+", " ")), " +")
    kept = F.slice(F.filter(words, lambda w: (w != "") & ~w.isin("attachments", "pages")), 1, 12)
    alike = F.coalesce("report_like", F.lit(False)) | said.rlike(fv.DASHBOARD_WORDS)
    return scored.withColumn("group_key", F.when(alike, F.nullif(F.array_join(kept, " "), F.lit(""))))


def image_page_caps(
    scored: DataFrame,
    *,
    cap: int = 20,
    priority_pages=(),
    priority_cap: int | None = None,
    adaptive: bool = True,
    report_cap: int = 12,
) -> DataFrame:
    """Add ``page_cap`` (negative: no cap)."""
    own = F.lit(cap)
    if priority_pages and priority_cap is not None:
        own = F.when(F.col("page_id").isin(list(priority_pages)), priority_cap).otherwise(cap)
    if adaptive:
        own = F.when((own >= 0) & F.coalesce("report_like", F.lit(False)), F.least(own, F.lit(report_cap))).otherwise(own)
    return scored.withColumn("page_cap", own)


def image_rank(scored: DataFrame) -> DataFrame:
    """Add ``rank`` per page by score, then order of discovery."""
    order = Window.partitionBy("document_id").orderBy(F.desc("selection_score"), "source_order")
    return scored.withColumn("rank", F.row_number().over(order))


def image_select(ranked: DataFrame, *, per_group: int = 3) -> DataFrame:
    """Add ``decision``: selected, representative_group_omitted or page_cap_omitted.

    Going down the rank until the cap is reached, at most ``per_group`` images of a look-alike
    group are taken. Two windows say the same without a loop: images within their group limit are
    eligible, and an image is cut by the cap once that many eligible ones precede it.
    """
    in_group = Window.partitionBy("document_id", "group_key").orderBy("rank")
    earlier = Window.partitionBy("document_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    eligible = F.col("group_key").isNull() | (F.row_number().over(in_group) <= per_group)
    return (
        ranked.withColumn("_ok", eligible)
        .withColumn("_before", F.coalesce(F.sum(F.col("_ok").cast("int")).over(earlier), F.lit(0)))
        .withColumn(
            "decision",
            F.when((F.col("page_cap") >= 0) & (F.col("_before") >= F.col("page_cap")), "page_cap_omitted")
            .when(~F.col("_ok"), "representative_group_omitted")
            .otherwise("selected"),
        )
        .drop("_ok", "_before")
    )


def image_ids(selected: DataFrame) -> DataFrame:
    """Add ``image_id`` for selected images: running number and start of the source's hash."""
    order = Window.partitionBy("document_id").orderBy("rank")
    return selected.withColumn("_n", F.row_number().over(order)).withColumn(
        "image_id", F.format_string("image-%03d-%s", "_n", F.substring(F.sha2("source", 256), 1, 10))
    ).drop("_n")


def omitted_image_inventory(decided: DataFrame) -> DataFrame:
    """Every image that was not selected, with the reason."""
    return decided.where("decision <> 'selected'").select(
        "document_id", "page_id", "space_key", "source_order", "source", "source_kind", "mime_type",
        F.col("decision").alias("omitted_reason"), "selection_score", "selection_reasons", "nearby_heading",
    )


# ---- content ---------------------------------------------------------------------------------


def _jpeg_size(content: bytes | None):
    """(width, height) from the frame header of a JPEG, or None."""
    if content is None:
        return None
    at, end = 2, len(content)
    while at + 9 < end:
        if content[at] != 0xFF:
            at = content.find(b"\xff", at)
            if at < 0:
                return None
            continue
        marker = content[at + 1]
        at += 2
        if marker in (0xD8, 0xD9):
            continue
        size = int.from_bytes(content[at : at + 2], "big")
        if size < 2 or at + size > end:
            return None
        # frame headers are C0..CF without C4, C8 and CC
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(content[at + 5 : at + 7], "big"), int.from_bytes(content[at + 3 : at + 5], "big")
        at += size
    return None


_SIZE = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])


@F.pandas_udf(_SIZE)
def _jpeg_sizes(content: pd.Series) -> pd.DataFrame:
    found = [_jpeg_size(c) for c in content]
    return pd.DataFrame(
        {"width": [f[0] if f else None for f in found], "height": [f[1] if f else None for f in found]}
    ).astype({"width": "Int32", "height": "Int32"})


def data_url_content(source: Column) -> Column:
    return F.try_to_binary(F.regexp_extract(source, "(?s)^[^,]*,(.*)$", 1), F.lit("base64"))


def image_profile(images: DataFrame, *, min_pixels: int = 4096, skip_low_value: bool = True) -> DataFrame:
    """Add hash, type, size and ``low_value_reason`` to rows with ``source``, ``source_kind``, ``content``.

    The header of PNG and GIF is read by SQL; only JPEG bytes go to Python.
    """
    head = F.hex(F.substring("content", 1, 8))
    png = head.startswith("89504E470D0A1A0A") & (F.length("content") >= 24)
    gif = head.startswith("474946383761") | head.startswith("474946383961")
    jpeg = head.startswith("FFD8")

    def number(start: int, reverse: bool = False) -> Column:
        if reverse:
            digits = F.concat(F.hex(F.substring("content", start + 1, 1)), F.hex(F.substring("content", start, 1)))
        else:
            digits = F.hex(F.substring("content", start, 4))
        return F.conv(digits, 16, 10).cast("int")

    sized = images.withColumns(
        {
            "content_sha256": F.sha2("content", 256),
            "_jpeg": _jpeg_sizes(F.when(jpeg, F.col("content"))),
        }
    ).withColumns(
        {
            "width": F.when(png, number(17)).when(gif, number(7, True)).when(jpeg, F.col("_jpeg.width")),
            "height": F.when(png, number(21)).when(gif, number(9, True)).when(jpeg, F.col("_jpeg.height")),
        }
    )
    name = F.lower(F.substring_index(_unquote(_path(F.col("source"))), "/", -1))
    pixels = F.col("width").cast("bigint") * F.col("height")
    reason = F.when(
        name.rlike(fv.IMAGE_LOW_VALUE_NAME), "filename suggests logo/icon/placeholder content"
    ).when(pixels <= min_pixels, F.format_string("tiny image dimensions %dx%d", "width", "height"))
    return sized.withColumn(
        "low_value_reason", reason if skip_low_value else F.lit(None).cast("string")
    ).drop("_jpeg")


def extraction_cache(earlier: DataFrame) -> DataFrame:
    """(content_sha256, answer): the first successful extraction per hash in page order."""
    order = ["space_key", "page_id", "pos"]
    answer = F.struct("ocr_text", "caption", "confidence", "provider", "model", "prompt_version")
    return (
        earlier.where("status = 'success' and content_sha256 <> ''")
        .groupBy("content_sha256")
        .agg(F.min_by(answer, F.struct(*order)).alias("answer"))
    )


def image_cache_join(profiled: DataFrame, cache: DataFrame, *, hot_rows: int = 1_000_000) -> DataFrame:
    """Add ``answer`` and ``cache_hit``; one picture used on very many pages is joined in pieces."""
    joined = salted_join(
        profiled, cache, "content_sha256", by=["document_id", "source"], hot_rows=hot_rows
    )
    return joined.withColumn("cache_hit", F.col("answer").isNotNull())


ANSWER = "ocr_text string, caption string, confidence double, error_type string"


def extract_images(
    profiled: DataFrame,
    cache: DataFrame,
    predict: Callable[[pd.DataFrame], pd.DataFrame],
    *,
    provider: str,
    model: str,
    prompt_version: str = "visual-ocr-v1",
) -> DataFrame:
    """One result row per selected image: skipped, reused, extracted or failed.

    Remote sources are skipped, unreadable ones fail, low-value ones are skipped, known hashes are
    reused. ``predict`` sees every remaining distinct hash once, in batches
    (``content_sha256, content, mime_type, source`` in; ``content_sha256, ocr_text, caption,
    confidence, error_type`` out). An empty answer is a failure, and so is an image for which ``predict`` raises: a
    batch that raises is halved until the images it refuses are found. Bytes are read again for one owner of
    each hash that is not in the cache; a counted list of at most 200,000 owners goes to the scan.
    """
    remote = F.col("source_kind") == "url"
    low = F.col("low_value_reason").isNotNull()
    place = F.struct("space_key", "page_id", "image_id")
    slim = cut_lineage(profiled.drop("content"))
    new = slim.where(~remote & F.col("content_sha256").isNotNull() & ~low).join(cache.select("content_sha256"), "content_sha256", "left_anti")
    owners = cut_lineage(new.groupBy("content_sha256").agg(F.min(place).alias("owner")))
    wanted = owners.select("content_sha256", "owner.*")
    distinct = (
        profiled.where(F.col("content").isNotNull())
        .join(broadcast_if_small(wanted, max_rows=200_000), wanted.columns, "left_semi")
        .groupBy("content_sha256")
        .agg(F.min_by(F.struct("content", "mime_type", "source"), place).alias("x"))
        .select("content_sha256", "x.*")
    )
    names = ["content_sha256", "ocr_text", "caption", "confidence", "error_type"]

    def asked(batch: pd.DataFrame) -> pd.DataFrame:
        try:
            return predict(batch)[names]
        except Exception as problem:  # one refused image must not cost the others their answer
            if len(batch) > 1:
                half = len(batch) // 2
                return pd.concat([asked(batch.iloc[:half]), asked(batch.iloc[half:])], ignore_index=True)
            return pd.DataFrame({"content_sha256": batch["content_sha256"], "error_type": type(problem).__name__}).reindex(columns=names)

    def run(batches):
        for batch in batches:
            if len(batch):
                told = asked(batch[["content_sha256", "content", "mime_type", "source"]])
                for name in ("ocr_text", "caption", "error_type"):
                    told[name] = told[name].astype("object").where(told[name].notna(), None)
                told["confidence"] = pd.to_numeric(told["confidence"])
                yield told

    answered = distinct.mapInPandas(run, "content_sha256 string, " + ANSWER)
    fresh = answered.select(
        "content_sha256",
        F.struct(
            F.coalesce("ocr_text", F.lit("")).alias("ocr_text"), F.coalesce("caption", F.lit("")).alias("caption"),
            F.when(F.col("confidence").between(0, 1), F.col("confidence")).alias("confidence"), "error_type",
        ).alias("fresh"),
    )
    # model calls are never repeated by a later recomputation
    fresh = cut_lineage(fresh)
    known = image_cache_join(slim, cache)
    joined = salted_join(
        known, fresh.join(owners, "content_sha256"), "content_sha256", by=["document_id", "source"]
    )
    text = F.coalesce("answer.ocr_text", "fresh.ocr_text", F.lit(""))
    caption = F.coalesce("answer.caption", "fresh.caption", F.lit(""))
    owns = F.col("owner") == F.struct("space_key", "page_id", "image_id")
    missing = F.col("fresh").isNull()
    empty = (tx.strip(text) == "") & (tx.strip(caption) == "")
    refused = F.coalesce(F.col("fresh.error_type"), F.lit("")) != ""
    used = F.col("cache_hit") | ~missing
    failed = F.when(F.col("cache_hit"), F.lit(False)).otherwise(empty | refused)
    unreadable = ~remote & F.col("content_sha256").isNull()
    status = (
        F.when(remote, "skipped").when(unreadable, "failed").when(low, "skipped").when(failed | ~used, "failed").otherwise("success")
    )
    error = (
        F.when(remote, "remote_source_not_in_cache")
        .when(unreadable, "unreadable")
        .when(low, "low_value_visual")
        .when(F.col("cache_hit"), F.lit(None).cast("string"))
        .when(refused, F.col("fresh.error_type"))
        .when(empty, "empty_answer")
    )
    shown = (status == "success")
    return joined.select(
        "document_id", "page_id", "space_key", "rank", "image_id", "source", "source_kind", "mime_type", "content_sha256",
        status.alias("status"),
        F.when(shown, text).otherwise("").alias("ocr_text"),
        F.when(low & ~remote, F.concat(F.lit("Skipped before OCR: "), "low_value_reason", F.lit(".")))
        .when(shown, caption).otherwise("").alias("caption"),
        F.when(shown, F.coalesce("answer.confidence", "fresh.confidence")).alias("confidence"),
        F.lit(provider).alias("provider"), F.lit(model).alias("model"), F.lit(prompt_version).alias("prompt_version"),
        (F.col("cache_hit") | (shown & ~F.coalesce(owns, F.lit(False)))).alias("cache_hit"),
        error.alias("error_type"),
    )


def images_to_do(pages: DataFrame, artifacts: DataFrame, *, force: bool = False) -> DataFrame:
    """Pages whose stored artifact is absent, incomplete or of another content hash."""
    if force:
        return pages
    done = artifacts.where("status = 'complete'").select("document_id", "source_content_hash")
    return pages.join(done, ["document_id", "source_content_hash"], "left_anti")


def image_artifacts(results: DataFrame, pages: DataFrame) -> DataFrame:
    """One artifact row per page: counts, status, images (bounded by the page cap)."""
    from corpuswright.operators.reports import page_visual_status

    image = F.struct(
        "rank", "image_id", "source", "source_kind", "mime_type", "content_sha256", "status", "ocr_text", "caption",
        "confidence", "provider", "model", "prompt_version", "cache_hit", "error_type",
    )
    listed = results.groupBy("document_id").agg(F.array_sort(F.collect_list(image)).alias("images"))
    zero = F.lit(0).cast("bigint")
    joined = (
        pages.select("document_id", "page_id", "space_key", "source_content_hash")
        .join(page_visual_status(results), "document_id", "left")
        .join(listed, "document_id", "left")
    )
    return joined.withColumns(
        {
            **{c: F.coalesce(c, zero) for c in ("image_count", "images_succeeded", "images_failed", "images_skipped")},
            "status": F.coalesce("status", F.lit("skipped")),
        }
    )


def visual_index_rows(artifacts: DataFrame) -> DataFrame:
    """One flat row per image of an artifact."""
    return artifacts.select(
        "document_id", "page_id", "space_key", "source_content_hash", F.explode("images").alias("i")
    ).select("document_id", "page_id", "space_key", "source_content_hash", "i.*")


def image_dedupe_render(
    images: DataFrame, *, dedupe: bool = True, max_images: int | None = None, max_ocr_chars: int | None = None
) -> DataFrame:
    """Per image of a page: whether the export shows it, and its shortened text.

    Successful images only; the first of every content hash, then the first ``max_images`` if given.
    ``outcome`` is shown, duplicate or truncated; ``ocr_cut`` marks shortened text.
    """
    good = images.where("status = 'success'").repartition("document_id")
    same = Window.partitionBy("document_id", "content_sha256").orderBy("rank")
    repeat = (
        F.when(F.coalesce("content_sha256", F.lit("")) == "", F.lit(False)).otherwise(F.row_number().over(same) > 1)
        if dedupe
        else F.lit(False)
    )
    marked = good.withColumn("_repeat", repeat)
    order = Window.partitionBy("document_id", "_repeat").orderBy("rank")
    shown = F.rtrim(tx.head(F.col("ocr_text"), max_ocr_chars))
    long = F.lit(False) if max_ocr_chars is None else F.length("ocr_text") > max_ocr_chars
    beyond = F.lit(False) if max_images is None else F.col("_n") > max_images
    return marked.withColumn("_n", F.row_number().over(order)).select(
        "document_id", "rank", "image_id", "source", "caption",
        F.when(F.col("_repeat"), "duplicate").when(beyond, "truncated").otherwise("shown").alias("outcome"),
        F.when(long, shown).otherwise(F.col("ocr_text")).alias("ocr_shown"),
        long.alias("ocr_cut"),
    )


def visual_text(rendered: DataFrame) -> DataFrame:
    """(document_id, visual_text): the section of an exported document."""
    shown = F.col("outcome") == "shown"
    block = F.concat_ws(
        "\n\n",
        F.concat(F.lit("### "), "image_id"),
        F.concat(F.lit("Source: "), "source"),
        F.when(F.col("caption") != "", F.concat(F.lit("Caption: "), "caption")),
        F.when(
            F.col("ocr_shown") != "",
            F.concat(
                F.lit("OCR text:\n\n```text\n"), "ocr_shown",
                F.when(F.col("ocr_cut"), "\n[truncated]").otherwise(""), F.lit("\n```"),
            ),
        ),
    )
    grouped = rendered.groupBy("document_id").agg(
        F.array_sort(F.collect_list(F.when(shown, F.struct("rank", block.alias("block"))))).alias("_b"),
        F.count_if(F.col("outcome") == "duplicate").alias("_dup"),
        F.count_if((F.col("outcome") == "truncated") | (shown & F.col("ocr_cut"))).alias("_cut"),
    )
    return grouped.select(
        "document_id",
        F.concat_ws(
            "\n\n",
            F.lit("## Extracted Visual Content"),
            F.lit("Text and captions read from images. Use as evidence for retrieval and review; recognition errors are possible."),
            F.array_join(F.transform("_b", lambda b: b["block"]), "\n\n"),
            F.when(F.col("_dup") > 0, F.format_string("Duplicate visual images omitted from this section: %d", "_dup")),
            F.when(F.col("_cut") > 0, F.format_string("Images or image texts truncated: %d", "_cut")),
        ).alias("visual_text"),
    )
