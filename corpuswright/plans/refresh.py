"""The enrichment job as an incremental run: what changed is computed, the rest is carried over.

A run leaves a state in a folder: what each page yields on its own (``features``, with keywords), the finished pages, what
pages contribute to the roll-ups (``members``), the size of each group of siblings (``families``) and the rolled-up
terms. The next run compares signatures of slim columns and then goes from difference to difference:

* the rules on text run on new and changed pages only;
* the family sizes get signed deltas, and pages whose child or sibling counts change thereby, or whose own
  row changed, are finished again from their slim features;
* the roll-ups get signed deltas too: a page that is finished again, or gone, takes its old contributions out
  and puts its new ones in. Counts follow by addition. A term's first form is a minimum, which cannot be taken back;
  it is looked up again among the members of just those terms whose first form went out.

Tables are partitioned by a hash of the key, and only the partitions with a change are written, by Spark's
dynamic partition overwrite, after everything that reads the old state is on disk. A state file names the run that is
complete; a run that finds an unfinished one rebuilds the state in full.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswright.operators import hierarchy as hi
from corpuswright.operators import rollups as ro
from corpuswright.operators.incremental import config_signature, row_signature
from corpuswright.plans.enrich import finished_pages, own_features
from corpuswright.session import cut_lineage, salted_join

# columns a page's result depends on besides its text and Markdown, which their hash stands for
SLIM = ["title", "status", "updated_at", "url", "labels", "ancestors", "links", "attachment_names", "source_content_hash"]
KINDS = ("themes", "concepts")
UNKNOWN_HASH = "sha256:unknown"  # of a page whose export has no hash; such pages are always computed anew
# the columns that tell a table's rows of one page, family or term; the last one picks the partition
TABLES = {"features": ["document_id"], "pages": ["document_id"], "members": ["document_id"], "families": ["parent"], "terms": ["kind", "term"]}


@dataclass(frozen=True)
class Refreshed:
    """Finished pages, the roll-up of their terms, and how each page came about (``recomputed``, ``placed``, ``carried``)."""

    pages: DataFrame
    terms: DataFrame
    branches: DataFrame


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def _mark(spark: SparkSession, folder: str, complete: bool) -> None:
    """A state is complete while the folder holds the mark."""
    files, path = _files(spark, folder)
    mark = path(f"{folder}/COMPLETE")
    if complete:
        files.create(mark, True).close()
    else:
        files.delete(mark, False)


def has_state(spark: SparkSession, folder: str) -> bool:
    files, path = _files(spark, folder)
    return files.exists(path(f"{folder}/COMPLETE"))


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}")


def _replace(folder: str, table: str, rows: DataFrame, buckets: int) -> None:
    """Write all partitions that ``rows`` touches; the others stay as they are."""
    keyed = rows if "bucket" in rows.columns else rows.withColumn("bucket", _bucket(TABLES[table][-1], buckets))
    keyed.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{folder}/{table}")


def _changed_partitions(spark: SparkSession, folder: str, table: str, gone: DataFrame, new: DataFrame, buckets: int) -> DataFrame:
    """The rows of every partition with a change: those that stay (keys not in ``gone``), and ``new``.

    A partition that loses all its rows gets a row of nulls, or it would not be replaced.
    """
    keys = TABLES[table]
    key = keys[-1]
    old = _read(spark, folder, table)
    new = new.withColumn("bucket", _bucket(key, buckets))
    gone = gone.select(*keys).distinct().withColumn("bucket", _bucket(key, buckets))
    touched = gone.select("bucket").unionByName(new.select("bucket")).distinct()
    stay = old.join(F.broadcast(touched), "bucket", "left_semi").where(F.col(key).isNotNull())  # at most ``buckets`` rows
    stay = stay.join(gone.select(*keys), keys, "left_anti")
    hold = touched.select("bucket", *[F.lit(None).cast(f.dataType).alias(f.name) for f in old.schema if f.name != "bucket"])
    return stay.unionByName(new.select(*stay.columns)).unionByName(hold.select(*stay.columns))


def _rows(table: DataFrame, key: str) -> DataFrame:
    return table.where(F.col(key).isNotNull()).drop("bucket")


def page_signature(pages: DataFrame, settings: Mapping) -> Column:
    """Signature of everything a page's own result depends on; texts take part by their content hash."""
    known = [c for c in SLIM if c in pages.columns]
    return F.sha2(F.concat(row_signature(F.struct(*known)), F.lit(config_signature(settings))), 256)


def contributions(pages: DataFrame) -> DataFrame:
    """(document_id, kind, term, first): what each finished page adds to the roll-ups."""
    parts = [ro.term_members(pages, kind).withColumn("kind", F.lit(kind)) for kind in KINDS]
    return reduce(DataFrame.unionByName, parts).select("document_id", "kind", "term", "first")


def _summed(members: DataFrame) -> DataFrame:
    return members.groupBy("kind", "term").agg(F.count(F.lit(1)).alias("document_count"), F.min("first").alias("first"))


def _families(pages: DataFrame) -> DataFrame:
    return pages.groupBy("parent").agg(F.count(F.lit(1)).alias("size"))


def _counts(places: DataFrame, families: DataFrame) -> DataFrame:
    """(document_id, child_count, sibling_count) of ``places`` (document_id, page_id, parent)."""
    children = families.where(F.col("parent") != hi.ROOT).select(F.col("parent").alias("page_id"), F.col("size").alias("child_count"))
    placed = salted_join(places, families, "parent", by=["document_id"])
    return placed.join(children, "page_id", "left").select(
        "document_id",
        F.coalesce("child_count", F.lit(0)).alias("child_count"),
        F.greatest(F.coalesce("size", F.lit(1)) - 1, F.lit(0)).alias("sibling_count"),
    )


def refresh(
    pages: DataFrame, folder: str, as_of, *, settings: Mapping | None = None, buckets: int = 64,
    features: Callable[..., DataFrame] = own_features, **options,
) -> Refreshed:
    """Bring the state in ``folder`` up to ``pages`` (one row per document_id) and return it.

    ``settings`` are what the results depend on besides the pages; together with ``options`` (which go to
    ``own_features``) they are part of every signature, so a change of them computes all pages anew. What depends on
    ``as_of`` stays as it was judged by the run that computed a page; name the day in ``settings`` to judge all anew.
    """
    spark = pages.sparkSession
    config = {"settings": dict(settings or {}), "options": {k: repr(v) for k, v in sorted(options.items())}}
    parent = F.coalesce(hi.parent_id(F.col("ancestors")), F.lit(hi.ROOT))
    told = (F.col("source_content_hash") != UNKNOWN_HASH).alias("told")
    now = cut_lineage(pages.select("document_id", "page_id", parent.alias("parent"), page_signature(pages, config).alias("signature"), told))
    if not has_state(spark, folder):
        return _first_run(spark, pages, now, folder, as_of, buckets, features, options)

    # 1. pages by what became of them
    stored = _rows(_read(spark, folder, "features"), "document_id").select(
        "document_id", F.col("page_id").alias("old_page"), F.col("parent").alias("old_parent"), F.col("signature").alias("old_signature")
    )
    fates = cut_lineage(now.join(stored, "document_id", "full_outer"))
    changed = fates.where("signature is not null and (old_signature is null or signature <> old_signature or not told)")
    gone = fates.where("signature is null").select("document_id")

    # 2. rules on text, for changed pages only
    todo = pages.join(changed.select("document_id"), "document_id", "left_semi")
    fresh = features(todo, as_of, **options).join(now.drop("page_id", "told"), "document_id")
    fresh = cut_lineage(fresh)

    # 3. signed deltas of the family sizes, and the pages they reach
    moved = fates.where("signature is null or old_signature is null or parent <> old_parent")
    entering = moved.where("parent is not null").select("parent", F.lit(1).alias("d"))
    leaving = moved.where("old_parent is not null").select(F.col("old_parent").alias("parent"), F.lit(-1).alias("d"))
    delta = cut_lineage(entering.unionByName(leaving).groupBy("parent").agg(F.sum("d").alias("d")).where("d <> 0"))
    families = _rows(_read(spark, folder, "families"), "parent")
    resized = delta.join(families, "parent", "left").select("parent", (F.coalesce("size", F.lit(0)) + F.col("d")).alias("size"))
    resized = cut_lineage(resized)
    families = cut_lineage(families.join(delta, "parent", "left_anti").unionByName(resized.where("size > 0")))
    living = fates.where("signature is not null")
    siblings = living.join(delta.select("parent"), "parent", "left_semi").select("document_id")
    parents = living.join(delta.select(F.col("parent").alias("page_id")), "page_id", "left_semi").select("document_id")
    reached = cut_lineage(changed.select("document_id").unionByName(siblings).unionByName(parents).distinct())

    # 4. finish the reached pages from their slim features
    old_features = _rows(_read(spark, folder, "features"), "document_id")
    kept = old_features.join(reached, "document_id", "left_semi").join(changed.select("document_id"), "document_id", "left_anti")
    slim = kept.unionByName(fresh)
    done = cut_lineage(finished_pages(slim, _counts(slim.select("document_id", "page_id", "parent"), families)))

    # 5. signed deltas of the roll-ups
    out = cut_lineage(reached.unionByName(gone))
    members = _rows(_read(spark, folder, "members"), "document_id")
    leave = cut_lineage(members.join(out, "document_id", "left_semi"))
    enter = cut_lineage(contributions(done))
    terms = _roll_forward(_rows(_read(spark, folder, "terms"), "term"), members, out, leave, enter)

    # 6. everything that reads the old state is on disk before its partitions are replaced
    branch = fates.where("signature is not null").select("document_id").join(changed.select("document_id", F.lit("recomputed").alias("c")), "document_id", "left")
    branch = branch.join(reached.withColumn("r", F.lit("placed")), "document_id", "left")
    branches = cut_lineage(branch.select("document_id", F.coalesce("c", "r", F.lit("carried")).alias("branch")))
    changes = {
        "features": (changed.select("document_id").unionByName(gone), fresh),
        "pages": (out, done),
        "members": (out, enter),
        "families": (resized, resized.where("size > 0")),
        "terms": (terms, terms.where("document_count > 0")),
    }
    written = {t: cut_lineage(_changed_partitions(spark, folder, t, *c, buckets)) for t, c in changes.items()}
    _mark(spark, folder, False)
    for table, rows in written.items():
        _replace(folder, table, rows, buckets)
    _mark(spark, folder, True)
    return _state(spark, folder, branches)


def _roll_forward(terms: DataFrame, members: DataFrame, out: DataFrame, leave: DataFrame, enter: DataFrame) -> DataFrame:
    """(kind, term, document_count, first) of the terms with a change; a count of 0 tells that the term is gone."""
    signed = leave.select("kind", "term", F.lit(-1).alias("d"), F.col("first").alias("lost"), F.lit(None).cast(enter.schema["first"].dataType).alias("won"))
    signed = signed.unionByName(enter.select("kind", "term", F.lit(1).alias("d"), F.lit(None).cast(enter.schema["first"].dataType).alias("lost"), F.col("first").alias("won")))
    delta = signed.groupBy("kind", "term").agg(F.sum("d").alias("d"), F.min("lost").alias("lost"), F.min("won").alias("won"))
    now = cut_lineage(
        delta.join(terms, ["kind", "term"], "left").select(
            "kind", "term", (F.coalesce("document_count", F.lit(0)) + F.col("d")).alias("document_count"),
            F.col("first").alias("old"), "won", F.coalesce(F.col("lost") == F.col("first"), F.lit(False)).alias("again"),
        )
    )
    # the first form went out: look for the next one among the members that stay, of these terms alone
    asked = now.where("again and document_count > 0").select("kind", "term")
    stay = members.join(asked, ["kind", "term"], "left_semi").join(out, "document_id", "left_anti")
    again = stay.groupBy("kind", "term").agg(F.min("first").alias("next"))
    first = F.least(F.when(F.col("again"), F.col("next")).otherwise(F.col("old")), F.col("won"))
    return cut_lineage(now.join(again, ["kind", "term"], "left").select("kind", "term", "document_count", first.alias("first")))


def _first_run(spark, pages, now, folder, as_of, buckets, features, options) -> Refreshed:
    slim = cut_lineage(features(pages, as_of, **options).join(now.drop("page_id", "told"), "document_id"))
    families = cut_lineage(_families(slim))
    done = cut_lineage(finished_pages(slim, _counts(slim.select("document_id", "page_id", "parent"), families)))
    members = cut_lineage(contributions(done))
    files, path = _files(spark, folder)
    files.delete(path(folder), True)
    for table, rows in (("features", slim), ("pages", done), ("members", members), ("families", families), ("terms", _summed(members))):
        _replace(folder, table, rows, buckets)
    _mark(spark, folder, True)
    return _state(spark, folder, now.select("document_id", F.lit("recomputed").alias("branch")))


def _state(spark: SparkSession, folder: str, branches: DataFrame) -> Refreshed:
    return Refreshed(
        _rows(_read(spark, folder, "pages"), "document_id"), _rows(_read(spark, folder, "terms"), "term"), branches
    )


def rolled_up(refreshed: Refreshed, kind: str, **options) -> DataFrame:
    """The published roll-up of ``themes`` or ``concepts`` (see ``operators.rollups.term_rows``)."""
    name = {"themes": "theme", "concepts": "concept"}[kind]
    rows = refreshed.terms.where(F.col("kind") == kind).drop("kind")
    return ro.theme_rows(rows, **options) if name == "theme" else ro.concept_rows(rows, **options)
