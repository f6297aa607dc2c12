"""Chosen-path join: all pairs of texts whose five-word shingles have a Jaccard similarity of 0.8 or more.

A text becomes a set of shingle hashes and a sketch of ``COORDINATES`` minimum hashes, the sampled tokens. Each run walks
a path of coordinates of its own: texts are split by their value at the run's first coordinate, buckets above
``bucket`` texts again at the next one, and so on; a pair stays together at each step with the probability of its
similarity. Runs are added until the target recall is reached for the greatest depth that occurred. Small
buckets are compared by brute force: first the sketches, then, for what passes, the exact sets. Buckets that stay
large at the last depth are cut into cells of two groups, so no task sees more. A pair that meets in several runs
belongs to the first of them, so links are counted inside the cells and no list of pairs is ever made.

Equal texts are one text with a weight, so copies cost nothing. Defined results: texts without a word (null, empty, blank) link with
nothing; texts of fewer than five words are one shingle; copies of a text link with each other; classes are named by
their smallest id (null ids last), and one row of each class, smallest id first, is kept; repeated rows are copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpuswright.llm.common import WORD, fresh, let, words_of
from corpuswright.llm.graph import components
from corpuswright.session import broadcast_if_small, cut_lineage, release

COORDINATES = 64
MAX_DEPTH = 4
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word windows of all texts, concatenated, and how many each text has.

    ``words`` are the word hashes of all texts one after the other. A text shorter than ``size`` gives one window.
    """
    counts = np.where(lengths == 0, 0, np.maximum(lengths - size + 1, 1))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    owner = np.repeat(np.arange(len(counts)), counts)
    at = starts[owner] + np.arange(counts.sum()) - first[owner]
    end = starts[owner] + lengths[owner]
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            inside = at + j < end
            w = np.where(inside, words[np.minimum(at + j, len(words) - 1)] if len(words) else 0, np.uint64(0))
            h = _mix(h * np.uint64(31) + w + _GOLD * np.uint64(j + 1))
    return h, counts


def sketches(hashes: np.ndarray, counts: np.ndarray, coordinates: int = COORDINATES, seed: int = 11) -> np.ndarray:
    """Texts x coordinates minimum hashes (32 bits each) of texts with at least one shingle."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(1, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    out = np.empty((len(counts), coordinates), np.uint32)
    with np.errstate(over="ignore"):
        for j, a in enumerate(factors):
            x = hashes * a
            x = ((x ^ (x >> np.uint64(29))) * _GOLD) >> np.uint64(32)
            out[:, j] = np.minimum.reduceat(x.astype(np.uint32), starts)
    return out


def word_hashes(text: Column) -> Column:
    return let(words_of(text), lambda w: F.transform(w, lambda x: F.xxhash64(x)))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, starts and lengths of a list column."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return values, offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64)


def text_sketches(docs: DataFrame) -> DataFrame:
    """(key, sketch, bytes) for rows (key, text) that have a word; the hashing runs on Arrow batches of word hashes.

    ``bytes`` holds the last byte of each coordinate, enough to tell unlike texts apart inside a bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                part = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in part.columns], names=part.schema.names)
                values, starts, lengths = _flat(part.column(1))
                hashes, counts = shingle_hashes(values, starts, lengths)
                found = sketches(hashes, counts)
                flat = pa.array(found.view(np.int32).ravel())
                offsets = pa.array(np.arange(0, found.size + 1, COORDINATES, dtype=np.int32))
                small = pa.array([x.tobytes() for x in found.astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, flat), small], names=["key", "sketch", "bytes"])

    rows = docs.where(F.col("text").rlike(WORD)).select("key", word_hashes(F.col("text")).alias("w"))
    return rows.mapInArrow(run, "key string, sketch array<int>, bytes binary")


def runs_needed(depth: int, similarity: float, recall: float) -> int:
    """Runs after which a pair of the given similarity is missed with at most 1 - recall if each takes ``depth`` steps."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**depth))


def path(run: int, depth: int) -> int:
    """The coordinate that a run looks at in a step; runs start at different ones."""
    return int(run if depth == 0 else np.random.default_rng([run, depth]).integers(COORDINATES))


def assign_buckets(texts: DataFrame, runs: range, bucket: int) -> tuple[DataFrame, int]:
    """Rows (uid, run, leaf, n) of the texts that share their last bucket with others, and the greatest depth.

    One round per depth; only buckets above ``bucket`` texts go on to the next.
    """
    live = texts.select("uid", "sketch", F.explode(F.array(*[F.lit(r) for r in runs])).alias("run"), F.lit(0).cast("long").alias("leaf"))
    done, depth = [], 0
    while True:
        at = F.element_at(F.array(*[F.lit(path(r, depth)) for r in runs]), F.col("run") - runs.start + 1)
        split = live.select("uid", "run", F.xxhash64("leaf", "run", F.get("sketch", at)).alias("leaf"))
        split = cut_lineage(split)
        sizes = cut_lineage(split.groupBy("run", "leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        depth += 1
        last = depth == MAX_DEPTH
        small = split.join(sizes if last else sizes.where(F.col("n") <= bucket), ["run", "leaf"])
        done.append(cut_lineage(small.select("uid", "run", "leaf", "n")))
        more = sizes.where(F.col("n") > bucket)
        if last or more.isEmpty():
            release(split, sizes)
            break
        rest = cut_lineage(split.join(more.drop("n"), ["run", "leaf"]))
        release(split, sizes)
        live = rest.join(texts.select("uid", "sketch"), "uid")
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out, depth


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``key`` of sorted batches; at most one group is held over between batches."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        k = table.column(key).to_numpy()
        edges = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1), len(k)]
        for a, b in zip(edges[:-2], edges[1:-1], strict=True):
            yield table.slice(a, b - a)
        rest = table.slice(edges[-2]) if len(k) else rest
    if rest is not None and rest.num_rows:
        yield rest


def _matrix(column: pa.ChunkedArray, width: int, kind) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _owned(leaves: np.ndarray, run: int, side: np.ndarray) -> np.ndarray:
    """Mask of the pairs (i, j) that first meet in ``run``, among those of different sides or of one cell."""
    n = len(leaves)
    mask = ~np.eye(n, dtype=bool)
    if side.any():
        mask &= side[:, None] != side[None, :]
    for r in range(run):
        own = leaves[:, r]
        mask &= (own[:, None] != own[None, :]) | (own == 0)[:, None]
    return mask


def _run_grouped(rows: DataFrame, key: str, per_group, schema: str) -> DataFrame:
    """Apply ``per_group`` (Table to dict of columns, or None) to rows sorted by ``key`` in hash partitions."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    spark_schema: StructType = _parse_datatype_string(schema)
    arrow_schema = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for group in _groups(batches, key):
            if (out := per_group(group)) is not None:
                waiting.append(pa.RecordBatch.from_pydict(out, schema=arrow_schema))
                n += waiting[-1].num_rows
                if n > 5000:
                    yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                    waiting, n = [], 0
        if waiting:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, spark_schema)


def likely_members(cells: DataFrame, runs: int, similarity: float) -> DataFrame:
    """(cell, uid) of texts with a partner in the cell that first meets them there and whose sketch is near enough.

    The least number of equal coordinates lies 5 standard deviations under what the similarity gives. Bytes that are
    equal by chance only let more through.
    """
    least = int(COORDINATES * similarity - 5 * math.sqrt(COORDINATES * similarity * (1 - similarity)))

    def per_group(t: pa.Table):
        n = t.num_rows
        if n < 2:
            return None
        sketch = np.frombuffer(b"".join(t["bytes"].to_pylist()), np.uint8).reshape(n, COORDINATES)
        leaves = _matrix(t["leaves"], runs, np.int64)
        same = np.zeros((n, n), np.uint8)
        for j in range(COORDINATES):
            same += sketch[:, j][:, None] == sketch[:, j][None, :]
        near = (same >= least) & _owned(leaves, t["run"][0].as_py(), t["side"].to_numpy())
        hit = near.any(axis=1)
        if not hit.any():
            return None
        return {"cell": t["cell"].to_numpy()[hit], "uid": t["uid"].to_numpy()[hit]}

    return _run_grouped(cells, "cell", per_group, "cell long, uid long")


def _sets(table: pa.Table) -> list[np.ndarray]:
    values, starts, lengths = _flat(table["w"].combine_chunks())
    hashes, counts = shingle_hashes(values, starts, lengths)
    ends = np.cumsum(counts)
    return [np.unique(hashes[e - c : e]) for e, c in zip(ends, counts, strict=True)]


def set_overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections: products of 0/1 matrices over the elements that occur twice or more."""
    n = len(sets)
    every = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[place]
    place, owner = number[place[keep]], owner[keep]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((n, n), np.float32)
    for a in range(0, int(shared.sum()), columns):
        lo, hi = np.searchsorted(place, [a, a + columns])
        m = np.zeros((n, columns), np.float32)
        m[owner[lo:hi], place[lo:hi] - a] = 1
        out += m @ m.T
    return out.astype(np.int64)


def linked_members(cells: DataFrame, runs: int, similarity: tuple[int, int]) -> DataFrame:
    """(uid, links, other): weighted number of exact links first met in a cell, and the smallest uid of the class so far."""
    up, down = similarity

    def per_group(t: pa.Table):
        n = t.num_rows
        if n < 2:
            return None
        leaves, uid, weight = _matrix(t["leaves"], runs, np.int64), t["uid"].to_numpy(), t["weight"].to_numpy()
        sets = _sets(t)
        size = np.array([len(s) for s in sets])
        both = set_overlaps(sets)
        linked = (down * both >= up * (size[:, None] + size[None, :] - both)) & _owned(leaves, t["run"][0].as_py(), t["side"].to_numpy())
        hit = linked.any(axis=1)
        if not hit.any():
            return None
        root = uid.copy()  # smallest uid reachable inside the cell
        while True:
            low = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (low == root).all():
                break
            root = low
        return {"uid": uid[hit], "links": (linked @ weight)[hit], "other": root[hit]}

    return _run_grouped(cells, "cell", per_group, "uid long, links long, other long")


def cut_into_cells(members: DataFrame, bucket: int) -> DataFrame:
    """``members`` (run, leaf, n, uid, ...) with a column ``cell``; leaves above ``bucket`` become cells of two groups.

    A member of such a leaf goes to one cell per group. Cells of one group have side 0 throughout; in a cell of two
    groups the sides are 1 and 2, and only pairs of different sides are compared there.
    """
    groups = F.ceil(F.col("n") / F.lit(bucket)).cast("int")
    own = F.pmod(F.xxhash64("uid", F.lit(5)), groups).cast("int")
    rows = members.withColumn("_g", own).withColumn("_o", F.explode(F.sequence(F.lit(0), groups - 1)))
    side = F.when(F.col("_g") == F.col("_o"), 0).when(F.col("_g") < F.col("_o"), 1).otherwise(2)
    cell = F.xxhash64("run", "leaf", F.least("_g", "_o"), F.greatest("_g", "_o"))
    return rows.withColumn("cell", cell).withColumn("side", side.cast("int")).drop("_g", "_o", "n")


def similar_texts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: tuple[int, int] = (4, 5), recall: float = 0.999, bucket: int = 512) -> DataFrame:
    """One row per document: row, doc_id, key (of the text), class_id, n_links, kept.

    ``similarity`` is a fraction, up over down. ``row`` numbers the rows of the input in the order of its scan.
    Runs Spark jobs while the plan is built; intermediate tables lie in the shared folder.
    """
    level = similarity[0] / similarity[1]
    key = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("key", key)
    slim = cut_lineage(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("some")))
    sketch = text_sketches(rows.select("key", "text")).groupBy("key").agg(F.first("sketch").alias("sketch"), F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("weight"))
    texts = cut_lineage(sketch.select(F.monotonically_increasing_id().alias("uid"), "key", "weight", "sketch", "bytes"))

    parts, have, need = [], 0, runs_needed(1, level, recall)
    while have < need:
        found, depth = assign_buckets(texts, range(have, need), bucket)
        parts.append(found)
        have, need = need, min(COORDINATES, max(need, runs_needed(depth, level, recall)))
    members = parts[0]
    for p in parts[1:]:
        members = members.unionByName(p)
    by_run = F.map_from_entries(F.collect_list(F.struct("run", "leaf")))  # at most one leaf per run
    leaves = members.groupBy("uid").agg(by_run.alias("m")).select("uid", F.array(*[F.coalesce(F.element_at("m", F.lit(r)), F.lit(0).cast("long")) for r in range(have)]).alias("leaves"))
    leaves = cut_lineage(leaves.join(texts.drop("sketch"), "uid"))
    cells = cut_into_cells(members.join(leaves.select("uid", "leaves", "bytes"), "uid"), bucket)
    likely = cut_lineage(likely_members(cells, have, level))

    wanted = cut_lineage(likely.select("uid").distinct().join(leaves.select("uid", "key"), "uid"))
    # up to a counted million hashes (some 20 MB) go to the texts; beyond that the texts meet them in a shuffle
    hashes = broadcast_if_small(cut_lineage(wanted.select(F.xxhash64("key").alias("hash")).distinct()), max_rows=1_000_000)
    full = rows.where(F.col("text").rlike(WORD)).withColumn("hash", F.xxhash64("key")).join(hashes, "hash", "left_semi")
    full = full.groupBy("key").agg(F.first("text").alias("text"))
    full = full.join(wanted, "key").select("uid", word_hashes(F.col("text")).alias("w"))
    again = cut_into_cells(members.join(leaves.select("uid", "leaves", "weight"), "uid"), bucket).join(likely, ["cell", "uid"])
    linked = cut_lineage(linked_members(again.join(full, "uid"), have, similarity))
    release(likely, *parts)

    roots = components(linked.select(F.col("uid").alias("a"), F.col("other").alias("b")))
    counts = linked.groupBy("uid").agg(F.sum("links").alias("links"))
    info = texts.select("uid", "key", "weight").join(counts, "uid", "left").join(roots.withColumnRenamed("v", "uid"), "uid", "left")
    info = cut_lineage(info.select("key", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "uid").alias("root")))
    release(linked, wanted, leaves, roots)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    grouped = cut_lineage(slim.join(info, "key", "left").select("row", "doc_id", "key", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.when(F.col("some"), F.col("root")).alias("root")))
    release(slim, info, texts)
    # classes of one row need no table: their row is its own first
    firsts = grouped.where("root is not null and n_links > 0").groupBy("root").agg(F.min(order).alias("first"))
    alone = grouped.where("root is null or n_links = 0").select("row", "doc_id", "key", F.col("doc_id").alias("class_id"), "n_links", F.lit(True).alias("kept"))
    classed = grouped.where("root is not null and n_links > 0").join(firsts, "root")
    return alone.unionByName(classed.select("row", "doc_id", "key", F.col("first.doc_id").alias("class_id"), "n_links", (F.col("row") == F.col("first.row")).alias("kept")))


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that are near copies of a row that stays; all columns kept.

    Rows equal in id and text are told apart by nothing else, so of several only one is left if they stay.
    """
    found = cut_lineage(similar_texts(docs, doc_id=doc_id, text=text, **options))
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # an id and a text are known by two hashes of 64 bits, so what the texts are joined with stays slim
    marks = [F.xxhash64(F.lit(seed), ident, F.col("key")) for seed in (1, 2)]
    same = found.groupBy(marks[0].alias("h1"), marks[1].alias("h2")).agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    same = cut_lineage(same.where("not stays or n > 1"))
    h1, h2 = fresh(docs, "_h1", "_h2")
    # up to a counted million pairs (some 30 MB) go to the texts; beyond that the texts meet them in a shuffle
    gone, repeated = (
        broadcast_if_small(cut_lineage(same.where(which).select(F.col("h1").alias(h1), F.col("h2").alias(h2))), max_rows=1_000_000)
        for which in ("not stays", "stays")
    )
    key = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    of_row = [F.xxhash64(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), key) for seed in (1, 2)]
    left = docs.withColumn(h1, of_row[0]).withColumn(h2, of_row[1]).join(gone, [h1, h2], "left_anti")
    once = left.join(repeated, [h1, h2], "left_anti")
    several = left.join(repeated, [h1, h2], "left_semi").dropDuplicates([h1, h2])
    return once.unionByName(several).select(*[F.col(f"`{c}`") for c in docs.columns])
