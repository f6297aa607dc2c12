"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.session import cut_lineage, release


def components(edges: DataFrame) -> DataFrame:
    """Cut table (v, root): the smallest vertex of the component of every vertex of ``edges`` (a, b).

    Each round points every vertex to its smallest neighbour, jumps twice, and contracts the edges, which at least
    halves the vertices of a component. Minima are combined on the map side and joins are plain, so Spark can
    split the rows of a vertex with very many edges. Runs jobs: a few per round.
    """
    live = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    found = cut_lineage(live.select(F.col("a").alias("v")).unionByName(live.select(F.col("b").alias("v"))).distinct().withColumn("root", F.col("v")))
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = cut_lineage(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("r")))
        for _ in range(2):
            ahead = to.select(F.col("a").alias("r"), F.col("r").alias("far"))
            jumped = cut_lineage(to.join(ahead, "r").select("a", F.col("far").alias("r")))
            release(to)
            to = jumped
        of_a, of_b, of_root = (to.select(F.col("a").alias(c), F.col("r").alias(f"r_{c}")) for c in ("a", "b", "root"))
        ends = live.join(of_a, "a").join(of_b, "b").where("r_a <> r_b")
        contracted = cut_lineage(ends.select(F.least("r_a", "r_b").alias("a"), F.greatest("r_a", "r_b").alias("b")).distinct())
        moved = cut_lineage(found.join(of_root, "root", "left").select("v", F.coalesce("r_root", "root").alias("root")))
        release(live, found, to)
        live, found = contracted, moved
    release(live)
    return found
