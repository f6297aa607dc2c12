"""Embedding near-duplicates by NN-descent.

Every vector keeps a list of its ``k`` best neighbours. The lists start from a few random-hyperplane forests' leaves and
are refined by neighbours-of-neighbours joins: the neighbours of a vector, in both directions, are compared with each
other as long as one of the two is new in its list, and what beats the worst entry of a list enters it. Refinement
works on vectors of bytes; links are decided in double precision. A list whose worst entry still
links is saturated; the lists of its whole class are then enlarged to the class, compared in blocks of bounded
size. Before that, saturated vectors are searched again with lists of vectors of other classes only, and classes that
link are joined, until none do: a class with a link out of it has it at the top of such a list. At the end the links of sampled vectors are counted by brute force, and rounds with new forests follow until vectors with
links have the target share of them on average, apart for dense classes by size and for all others. The forest grows with
the number of vectors, so that it alone brings two vectors that link together with that probability.

Equal vectors are one vector with a weight. Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; shorter vectors count as padded with zeros; a component is named by its smallest vec_id (nulls
last); rows with equal vec_id and vector are copies of each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.chosen_path import _run_grouped, cut_into_cells
from corpuswright.llm.graph import components
from corpuswright.session import cut_lineage, release

SCALE = 127 * 127
FOREST = 8
EXACT = 1 << 40  # scale of cosines of vectors of doubles
SLACK = 0.03  # more than byte vectors err on a cosine


def unit_vectors(rows: DataFrame, dimensions: int) -> DataFrame:
    """(row, vec_id, key, unit): unit vectors in doubles and a digest of them; both null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, units = [], []
            for x in batch.column(2):
                v = None if not x.is_valid else x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                largest = 0.0 if v is None or not len(v) or not np.isfinite(v).all() else np.abs(v).max()
                if not largest:
                    keys.append(None)
                    units.append(None)
                    continue
                v = np.pad(v / largest, (0, dimensions - len(v))) + 0.0
                raw = (v / math.sqrt(v @ v)).tobytes()
                keys.append(hashlib.md5(raw).hexdigest())
                units.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.string()), pa.array(units, pa.binary())], names=["row", "vec_id", "key", "unit"])

    return rows.mapInArrow(run, f"row long, vec_id {rows.schema['vec_id'].dataType.simpleString()}, key string, unit binary")


def _units(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)


def with_leaves(nodes: DataFrame, n: int, trees: int, leaf: int, seed: int, dimensions: int) -> DataFrame:
    """(group, uid, q) once per tree: the signs of as many random projections as leaves of ``leaf`` vectors need.

    Nodes with a column ``root`` have vectors of doubles and keep it.
    """
    wide = "root" in nodes.columns
    bits = max(0, math.ceil(math.log2(max(n, 1) / leaf)))
    planes = np.random.default_rng(seed).standard_normal((dimensions, trees * max(bits, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = (_units(batch.column(1), np.float64 if wide else np.int8).astype(np.float64) @ planes > 0).reshape(batch.num_rows, trees, -1)
            codes = signs @ (1 << np.arange(signs.shape[2], dtype=np.int64)) if bits else np.zeros((batch.num_rows, trees), np.int64)
            group = (np.arange(trees) + codes * trees).T.ravel()
            place = np.tile(np.arange(batch.num_rows), trees)
            yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int64)), *[c.take(pa.array(place)) for c in batch.columns]], names=["group", *batch.schema.names])

    return nodes.select("uid", "q", *["root"] * wide).mapInArrow(run, "group long, uid long, q binary" + ", root long" * wide)


def _products(t: pa.Table) -> np.ndarray:
    """Scaled cosines between the rows of ``t``; in a table with a column ``root`` no vector meets its own class."""
    if "root" not in t.column_names:
        q = _units(t["q"], np.int8).astype(np.float32)
        s = q @ q.T
        np.fill_diagonal(s, -np.inf)
        return s
    q, root = _units(t["q"]), t["root"].to_numpy()
    s = np.rint(q @ q.T * EXACT)
    s[root[:, None] == root[None, :]] = -np.inf
    return s


def leaf_candidates(leaves: DataFrame, k: int, leaf: int, seed: int) -> DataFrame:
    """(a, b, s, fresh): the ``k`` best neighbours inside a leaf; oversized leaves are split at random first."""
    sizes = cut_lineage(leaves.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 4 * leaf))
    part = F.coalesce(F.pmod(F.xxhash64("uid", F.lit(seed)), F.ceil(F.col("n") / F.lit(2 * leaf))), F.lit(0))
    rows = leaves.join(sizes, "group", "left").select(F.xxhash64("group", part).alias("cell"), *leaves.columns[1:])

    def per_group(t: pa.Table):
        n = t.num_rows
        if n < 2:
            return None
        s, uid = _products(t), t["uid"].to_numpy()
        m = min(k, n - 1)
        best = np.argpartition(-s, m - 1, axis=1)[:, :m]
        top = np.take_along_axis(s, best, 1).ravel()
        met = np.isfinite(top)
        return {"a": np.repeat(uid, m)[met], "b": uid[best].ravel()[met], "s": top[met].astype(np.int64), "fresh": np.ones(met.sum(), np.int64)}

    return _run_grouped(rows, "cell", per_group, "a long, b long, s long, fresh long")


def best_of(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best different ``b`` of each ``a``, read in sorted order; remembers one row, not a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_a, last_b, rank = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new_a = np.append(a[0] != last_a, a[1:] != a[:-1])
            new = new_a | np.append(b[0] != last_b, b[1:] != b[:-1])
            n = np.cumsum(new)
            start = np.maximum.accumulate(np.where(new_a, n, 0))
            place = np.where(start > 0, n - start, rank + n - 1)
            keep = new & (place < k)
            last_a, last_b, rank = a[-1], b[-1], int(place[-1]) + 1
            yield batch.filter(pa.array(keep))

    order = rows.repartition("a").sortWithinPartitions("a", F.desc("s"), "b", "fresh")
    return order.select("a", "b", "s", "fresh").mapInArrow(run, "a long, b long, s long, fresh long")


def refine(graph: DataFrame, nodes: DataFrame, k: int, ways: DataFrame | None = None) -> DataFrame:
    """Candidates (a, b, s, fresh) from comparing the neighbours of each vector with each other.

    Of the vectors that list a hub only its ``k`` best enter its comparison, as the method prescribes. ``ways`` (a, b)
    are further neighbours to go by, which do not enter the lists themselves.
    """
    backward = best_of(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "s", "fresh"), k)
    near = graph.unionByName(backward)
    if ways is not None:
        near = near.unionByName(ways.select("a", "b", F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("fresh")))
    around = near.groupBy("a", "b").agg(F.max("fresh").alias("fresh"))
    extra = ["root"] if "root" in nodes.columns else []
    worst = graph.groupBy("a").agg(F.min("s").alias("worst"), F.count(F.lit(1)).alias("n"))
    members = nodes.select("uid", "q", *extra).join(worst, nodes["uid"] == worst["a"], "left").select(F.col("uid").alias("b"), "q", *extra, F.when(F.col("n") >= k, F.col("worst")).otherwise(F.lit(-EXACT * 2)).alias("worst"))
    rows = around.join(members, "b").select(F.col("a").alias("v"), F.col("b").alias("uid"), "q", *extra, "worst", "fresh")

    def per_group(t: pa.Table):
        if t.num_rows < 2:
            return None
        s, uid = _products(t), t["uid"].to_numpy()
        fresh, worst = t["fresh"].to_numpy() > 0, t["worst"].to_numpy()
        better = (s > worst[:, None]) & (fresh[:, None] | fresh[None, :])
        i, j = np.nonzero(better)
        if not len(i):
            return None
        return {"a": uid[i], "b": uid[j], "s": s[i, j].astype(np.int64), "fresh": np.ones(len(i), np.int64)}

    return _run_grouped(rows, "v", per_group, "a long, b long, s long, fresh long")


def neighbour_graph(nodes: DataFrame, graph: DataFrame | None, n: int, *, k: int, trees: int, leaf: int, seed: int, dimensions: int, rounds: int = 6, least_change: float = 0.005, ways: DataFrame | None = None) -> DataFrame:
    """Cut table (a, b, s, fresh) of the neighbour lists after refinement."""
    now = None if graph is None else graph.withColumn("fresh", F.lit(0).cast("long"))
    for first in range(0, trees, FOREST):  # a few trees at a time, so that their rows never all lie on disk
        own = seed + 100_003 * first
        start = leaf_candidates(with_leaves(nodes, n, min(FOREST, trees - first), leaf, own, dimensions), k, leaf, own)
        lists = cut_lineage(best_of(start if now is None else start.unionByName(now), k))
        if first:
            release(now)
        now = lists
    for _ in range(rounds):
        old = now.withColumn("fresh", F.lit(0).cast("long"))
        after = cut_lineage(best_of(refine(now, nodes, k, ways).unionByName(old), k))
        release(now)
        now = after
        if now.where("fresh = 1").count() < least_change * n * k:
            break
    return now


def exact_links(graph: DataFrame, nodes: DataFrame, cosine: float, scale: int = SCALE) -> DataFrame:
    """Cut table (a, b), a < b: pairs of the lists whose cosine in doubles is at least ``cosine``."""
    near = graph.where(F.col("s") >= int((cosine - SLACK) * scale)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    a = nodes.select(F.col("uid").alias("a"), F.col("unit").alias("u"))
    b = nodes.select(F.col("uid").alias("b"), F.col("unit").alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                dots = np.einsum("ij,ij->i", _units(batch.column(2)), _units(batch.column(3)))
                yield batch.filter(pa.array(dots >= cosine)).select([0, 1])

    return cut_lineage(near.join(a, "a").join(b, "b").select("a", "b", "u", "w").mapInArrow(run, "a long, b long"))


def join_classes(graph: DataFrame, nodes: DataFrame, pairs: DataFrame, cosine: float, *, k: int, trees: int, leaf: int, seed: int, dimensions: int, recall: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cut tables of the links (a, b), their components (v, root) and the vectors (a) with a saturated list.

    A link that is in neither list has two saturated ends. If they lie in two classes, the link is found by lists, in
    doubles, of vectors of other classes. Classes that link are joined and searched again; each time at least
    halves the classes with a link out of them.
    """
    sizes = graph.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("worst"))
    full = cut_lineage(sizes.where((F.col("n") >= k) & (F.col("worst") >= int((cosine - SLACK) * SCALE))).select("a"))
    roots = components(pairs)
    for again in itertools.count():
        known = roots.select(F.col("v").alias("uid"), "root")
        saturated = nodes.join(full.withColumnRenamed("a", "uid"), "uid").join(known, "uid", "left")
        apart = cut_lineage(saturated.select("uid", F.col("unit").alias("q"), F.coalesce("root", "uid").alias("root"), "unit"))
        if apart.select("root").distinct().limit(2).count() < 2:
            release(apart)
            return pairs, roots, full
        m = apart.count()
        lists = neighbour_graph(apart, None, m, k=k, trees=forest_size(m, trees, leaf, cosine, recall), leaf=leaf, seed=seed + 11 * (again + 1), dimensions=dimensions, ways=graph)
        more = exact_links(lists, apart, cosine, EXACT)
        done = more.isEmpty()
        if not done:
            joined = cut_lineage(pairs.unionByName(more).distinct())
            release(pairs, roots)
            pairs, roots = joined, components(joined)
        release(apart, lists, more)
        if done:
            return pairs, roots, full


def links_in_classes(members: DataFrame, cosine: float, block: int) -> DataFrame:
    """(uid, links) by comparing all members (root, n, uid, unit, weight) of a class, in cells of two blocks."""
    cells = cut_into_cells(members.select(F.lit(0).alias("run"), F.col("root").alias("leaf"), "n", "uid", "unit", "weight"), block)

    def per_group(t: pa.Table):
        if t.num_rows < 2:
            return None
        v, side = _units(t["unit"]), t["side"].to_numpy()
        linked = v @ v.T >= cosine
        np.fill_diagonal(linked, False)
        if side.any():
            linked &= side[:, None] != side[None, :]
        return {"uid": t["uid"].to_numpy(), "links": linked @ t["weight"].to_numpy()}

    return _run_grouped(cells, "cell", per_group, "uid long, links long").groupBy("uid").agg(F.sum("links").alias("links"))


def _true_links(nodes: DataFrame, uid: np.ndarray, units: np.ndarray, cosine: float, at_once: int = 512) -> dict[int, int]:
    """Links of the given vectors by brute force."""
    shared = nodes.sparkSession.sparkContext.broadcast((uid, units))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, units = shared.value
        total = np.zeros(len(uid), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, v, weight = batch.column(0).to_numpy(), _units(batch.column(1)), batch.column(2).to_numpy()
            for i in range(0, len(uid), at_once):
                near = v @ units[i : i + at_once].T >= cosine
                near &= own[:, None] != uid[None, i : i + at_once]
                total[i : i + at_once] += weight @ near
        yield pa.RecordBatch.from_pydict({"uid": uid, "links": total})

    counted = nodes.select("uid", "unit", "weight").mapInArrow(run, "uid long, links long").groupBy("uid").agg(F.sum("links").alias("links")).collect()
    shared.destroy()
    return {r["uid"]: r["links"] for r in counted}


def audit(nodes: DataFrame, links: DataFrame, cosine: float, queries: int, enough: int = 128, limit: int = 64) -> float:
    """Least mean share of a sampled vector's true links that ``links`` (uid, links, layer) counts, over the layers.

    Layers are the vectors outside dense classes (0, or not in ``links``) and those of dense classes by the size of their
    class, so that no class speaks for vectors elsewhere. Every layer is sampled by ``queries`` vectors and then by more,
    until ``enough`` with a true link are seen, all are asked or ``limit`` times ``queries`` have been.
    """
    layered = nodes.select("uid").join(links, "uid", "left").select("uid", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("layer", F.lit(0)).alias("layer"))
    size = {r["layer"]: r["n"] for r in layered.groupBy("layer").agg(F.count(F.lit(1)).alias("n")).collect()}
    spot = F.pmod(F.xxhash64("uid", F.lit(41)), F.lit(1 << 40))
    shares: dict[int, list[float]] = {layer: [] for layer in size}
    asked, wanted = dict.fromkeys(size, 0.0), queries
    while open_layers := [x for x in size if len(shares[x]) < enough and asked[x] < 1 and asked[x] * size[x] < queries * limit]:
        take = F.lit(False)
        for x in open_layers:
            upto = min(1.0, wanted / size[x])
            take |= (F.col("layer") == x) & (spot >= int((1 << 40) * asked[x])) & (spot < int((1 << 40) * upto))
            asked[x] = upto
        rows = nodes.select("uid", "unit").join(F.broadcast(layered.where(take)), "uid").collect()
        if rows:
            true = _true_links(nodes, np.array([r["uid"] for r in rows]), _units(pa.array([r["unit"] for r in rows], pa.binary())), cosine)
            for r in rows:
                if true[r["uid"]]:
                    shares[r["layer"]].append(min(r["links"], true[r["uid"]]) / true[r["uid"]])
        wanted *= 4
    return min((sum(x) / len(x) for x in shares.values() if x), default=1.0)


def forest_size(n: int, trees: int, leaf: int, cosine: float, recall: float) -> int:
    """Trees, at least ``trees``, that bring two vectors at ``cosine`` into a common leaf with probability ``recall``."""
    bits = max(0, math.ceil(math.log2(max(n, 1) / leaf)))
    together = (1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi) ** bits
    if not bits or together >= recall or recall >= 1 or not together:
        return trees
    return max(trees, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def near_duplicates(
    vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = 0.95, k: int = 10, trees: int = 8, leaf: int = 128, block: int = 512,
    recall: float = 0.99, audit_queries: int = 512, max_rounds: int = 3,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Runs Spark jobs while the plan is built. Raises if the audited recall stays under ``recall``.
    """
    source = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).alias("vec_id"), F.col(embedding).alias("e"))
    dimensions = vectors.agg(F.max(F.size(embedding))).first()[0] or 1
    rows = cut_lineage(unit_vectors(source, max(dimensions, 1)))

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = [np.rint(np.frombuffer(x, np.float64) * 127).astype(np.int8).tobytes() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(q, pa.binary())], names=["uid", "weight", "unit", "key", "q"])

    same = rows.where("key is not null").groupBy("key").agg(F.min("row").alias("uid"), F.count(F.lit(1)).alias("weight"), F.first("unit").alias("unit"))
    nodes = cut_lineage(same.select("uid", "weight", "unit", "key").mapInArrow(bytes_of, "uid long, weight long, unit binary, key string, q binary"))
    n = nodes.count()
    graph, former, reached = None, None, 0.0
    for attempt in range(max_rounds):
        lists = neighbour_graph(nodes, graph, n, k=k, trees=forest_size(n, trees, leaf, cosine, recall), leaf=leaf, seed=101 + attempt, dimensions=max(dimensions, 1))
        if graph is not None:
            release(graph)
        graph = lists
        pairs = exact_links(graph, nodes, cosine)
        if former is not None:
            both = cut_lineage(pairs.unionByName(former).distinct())
            release(pairs, former)
            pairs = both
        pairs, roots, full = join_classes(graph, nodes, pairs, cosine, k=k, trees=trees, leaf=leaf, seed=1001 + 1000 * attempt, dimensions=max(dimensions, 1), recall=recall)
        dense = cut_lineage(roots.join(full, roots["v"] == full["a"]).select("root").distinct())
        sizes = roots.join(dense, "root").groupBy("root").agg(F.count(F.lit(1)).alias("n"))
        members = roots.join(sizes, "root").join(nodes.select(F.col("uid").alias("v"), "unit", "weight"), "v").withColumnRenamed("v", "uid")
        # classes of up to 16, 256, 4,096, ... vectors are layers of the audit
        layer = members.select("uid", F.ceil(F.log(F.col("n").cast("double")) / math.log(16)).cast("int").alias("layer"))
        inside = links_in_classes(members, cosine, block).join(layer, "uid").select("uid", "links", "layer")
        weight = nodes.select(F.col("uid").alias("b"), "weight")
        ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(roots.withColumnRenamed("v", "a"), "a").join(dense, "root", "left_anti")
        listed = ends.join(weight, "b").groupBy(F.col("a").alias("uid")).agg(F.sum("weight").alias("links"))
        links = cut_lineage(listed.withColumn("layer", F.lit(0)).unionByName(inside))
        reached = audit(nodes, links, cosine, audit_queries)
        if reached >= recall:
            break
        release(links, roots, full, dense)
        former = pairs
    else:
        raise RuntimeError(f"recall {reached:.3f} of sampled links after {max_rounds} rounds; raise k or trees")
    release(graph, pairs, full, dense)
    info = nodes.select("key", "uid", "weight").join(links.select("uid", "links"), "uid", "left").join(roots.withColumnRenamed("v", "uid"), "uid", "left")
    info = info.select("key", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "uid").alias("root"))
    joined = cut_lineage(rows.select("row", "vec_id", "key").join(info, "key", "left").select("row", "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "root"))
    order = F.struct(F.col("vec_id").isNull().alias("missing"), F.col("vec_id").alias("vec_id"), F.col("row").alias("row"))
    firsts = joined.where("n_links > 0").groupBy("root").agg(F.min(order).alias("first"))
    alone = joined.where("n_links = 0").select("vec_id", "n_links", F.col("vec_id").alias("component_id"))
    linked = joined.where("n_links > 0").join(firsts, "root").select("vec_id", "n_links", F.col("first.vec_id").alias("component_id"))
    return alone.unionByName(linked).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
