"""Session helpers: lineage cuts and size-checked broadcasts. Both run jobs while a plan is built."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for cut tables and scratch output.

    The cluster names it in ``spark.checkpoint.dir``; without that setting a cluster is refused. Only a session
    whose driver is its one executor (``local``), where a temporary folder is shared by definition, gets one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="corpuswright-")
    return _LOCAL[app]


def check_shared(spark: SparkSession, root: str) -> None:
    """Refuse a folder that executors of a cluster do not reach: a plain path outside the shared folder."""
    shared = shared_dir(spark).removeprefix("file://")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        if ("://" not in root or root.startswith("file:")) and not root.removeprefix("file://").startswith(shared):
            raise ValueError("use a folder that every executor reaches, such as one below spark.checkpoint.dir")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    Survives lost executors, is computed once, and later steps read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*cuts: DataFrame) -> None:
    """Delete tables written by ``cut_lineage`` once nothing lazy reads them any more."""
    for df in cuts:
        path = getattr(df, "_cut_path", None)
        if path:
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_if_small(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """Hint a broadcast only after counting at most ``max_rows + 1`` rows of ``df``."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    *,
    by: list[str],
    how: str = "left",
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Equi join ``big`` to ``small`` (unique on ``key``) without one task per hot key.

    Keys with more than ``hot_rows`` rows on the big side are split into pieces of at most
    ``hot_rows`` rows; the matching small row is copied once per piece. The list of hot keys has
    at most ``count(big) / hot_rows`` entries, which bounds the broadcast. ``by`` names columns that
    tell rows of a hot key apart; their hash picks the piece, so a repeated task picks the same. Rows
    without a key match nothing; a left join adds them afterwards instead of gathering them in one task.
    """
    keyless = big.where(F.col(key).isNull())
    big = big.where(F.col(key).isNotNull())
    pieces = (
        big.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(key, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_pieces"))
    )
    hot = broadcast_if_small(cut_lineage(pieces))
    left = big.join(hot, key, "left").withColumn(
        "_salt",
        F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*by), F.col("_pieces")).cast("int")
        ),
    )
    right = small.join(hot, key, "left").withColumn(
        "_salt",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)),
    )
    out = left.drop("_pieces").join(right.drop("_pieces"), [key, "_salt"], how).drop("_salt")
    return out.unionByName(keyless, allowMissingColumns=True) if how == "left" else out
