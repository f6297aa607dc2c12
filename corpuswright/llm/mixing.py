"""Mixing sources to target weights with hash-threshold histograms.

Every row gets a 52-bit hash. Per source the words are summed by the first bits of the hash; the
bucket in which the running sum crosses the source's budget is the only one refined by further bits,
until one hash value is left. A row is taken when its hash lies under the threshold of its source, so
no row is ever sorted, a larger budget takes a superset of a smaller one, and reruns agree.

Defined results: null text has size 0; null sources form one source, last in order; rows that are equal
in id and text share a hash and are taken or left together; an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuswright.llm.common import WORD, fresh
from corpuswright.session import cut_lineage, release

HASH_DIGITS = 13  # hexadecimal digits: 52 bits
LEVEL_BITS = (10, 14, 14, 14)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """Never null, and ordered by code point with the null source last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def source_targets(slim: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """Columns src, source_size, target, base, rest: one row per source.

    ``share`` times all words are dealt out by weight (repeating over the ordered sources). No target
    exceeds ``epochs`` times its source; what that leaves over goes to the others by weight. In order
    of size by weight the full sources come first, so the common factor of the others is the largest of the
    factors that remain after filling 0, 1, 2, ... of them. One row per source passes through one task.
    """
    sizes = slim.groupBy("src").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    sums = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(epochs))
        .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
        .withColumn("filled", F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
        .withColumn("open", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
    )
    factor = F.max((F.col("budget") - F.col("filled")) / F.col("open")).over(Window.partitionBy())
    target = F.greatest(F.lit(0.0), F.least(F.col("cap").cast("double"), F.col("weight") * factor))
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return (
        sums.withColumn("target", target)
        .withColumn("base", base.cast("long"))
        .select("src", "source_size", "target", "base", (F.col("target") - F.col("base") * F.col("source_size")).alias("rest"))
    )


def thresholds(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with a column ``threshold``: hashes under it are taken once more than ``base`` times.

    Each level sums words by source and the next bits of the hash, finds the bucket where the sum reaches
    the rest of the budget, and keeps only that bucket's rows for the next level. At the end the
    boundary row is taken if that brings the sum nearer to the budget.
    """
    targets = cut_lineage(targets)
    state = targets.where("rest > 0").select("src", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    rows, left, written = slim.select("src", "size", "h"), sum(LEVEL_BITS), []
    for level, bits in enumerate(LEVEL_BITS):
        left -= bits
        if level:
            at_boundary = state.select("src", F.col("prefix").alias("_p"))
            rows = rows.join(at_boundary, "src").where(F.shiftright("h", left + bits) == F.col("_p")).drop("_p")
            if level == 1:  # a thousandth of the rows is left; the levels after this one read only those
                rows = cut_lineage(rows)
                written.append(rows)
        in_bucket = rows.groupBy("src", F.shiftright("h", left).alias("bucket")).agg(F.sum("size").alias("s"))
        running = F.sum("s").over(Window.partitionBy("src").orderBy("bucket"))
        crossing = (
            in_bucket.join(state.select("src", "rest", "below"), "src")
            .withColumn("reached", F.col("below") + running)
            .where(F.col("reached") >= F.col("rest"))
            .groupBy("src")
            .agg(F.min(F.struct("bucket", "reached", "s", "rest")).alias("b"))
        )
        state = cut_lineage(crossing.select("src", "b.rest", F.col("b.bucket").alias("prefix"), (F.col("b.reached") - F.col("b.s")).alias("below"), F.col("b.s").alias("s")))
        written.append(state)
    nearer = (F.col("below") + F.col("s") - F.col("rest")) <= (F.col("rest") - F.col("below"))
    found = state.select("src", (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("threshold"))
    out = cut_lineage(targets.join(found, "src", "left").withColumn("threshold", F.coalesce("threshold", F.lit(0).cast("long"))))
    release(*written, targets)
    return out


def slim_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    d, t, s = F.col(doc_id), F.col(text), F.col(source)
    return docs.select(d.alias("doc_id"), s.alias("source"), source_key(s).alias("src"), word_count(t).alias("size"), row_hash(d, t).alias("h"))


def copies() -> Column:
    """How often the mix takes a row, from the columns ``h``, ``base`` and ``threshold``."""
    return F.col("base") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)


def mix_plan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Runs Spark jobs while the plan is built. The join to the sources' rows is left to Spark, which broadcasts
    them after measuring their written size.
    """
    slim = cut_lineage(slim_rows(docs, doc_id, text, source))
    found = thresholds(slim, source_targets(slim, weights, share, epochs))
    out = slim.join(found, "src").withColumn("copies", copies())
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """The documents of the mix, all their columns kept, each row as often as the mix takes it."""
    slim = cut_lineage(slim_rows(docs, doc_id, text, source))
    found = thresholds(slim, source_targets(slim, weights, share, epochs))
    release(slim)
    src, h, base, limit, again = fresh(docs, "_src", "_h", "_base", "_threshold", "_again")
    rows = docs.withColumn(src, source_key(F.col(source))).withColumn(h, row_hash(F.col(doc_id), F.col(text)))
    plan = found.select(F.col("src").alias(src), F.col("base").alias(base), F.col("threshold").alias(limit))
    times = F.col(base) + F.when(F.col(h) < F.col(limit), 1).otherwise(0)
    return rows.join(plan, src).withColumn(again, F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
