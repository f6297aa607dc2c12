"""Run history: which runs count, what failed, what was used."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SOURCE_COMMANDS = ["enrich", "extract-visuals"]


def source_runs(runs: DataFrame, *, commands: Iterable[str] = SOURCE_COMMANDS) -> DataFrame:
    return runs.where(F.col("command").isin(list(commands)))


def latest_run_per_command(runs: DataFrame, *, commands: Iterable[str] = SOURCE_COMMANDS) -> DataFrame:
    """The run with the largest id of every source command."""
    newest = Window.partitionBy("command").orderBy(F.desc("run_id"))
    return (
        source_runs(runs, commands=commands)
        .withColumn("_rn", F.row_number().over(newest))
        .where("_rn = 1")
        .drop("_rn")
    )


def select_runs(
    runs: DataFrame,
    *,
    run_ids: list[str] | None = None,
    all_runs: bool = False,
    commands: Iterable[str] = SOURCE_COMMANDS,
) -> DataFrame:
    """Requested runs (an unknown id raises), or all, or the latest per command."""
    chosen = source_runs(runs, commands=commands)
    if run_ids:
        wanted = sorted(set(run_ids))
        picked = chosen.where(F.col("run_id").isin(wanted))
        known = {r["run_id"] for r in picked.select("run_id").distinct().limit(len(wanted)).collect()}
        missing = [r for r in wanted if r not in known]
        if missing:
            raise ValueError("Unknown source run IDs: " + ", ".join(missing))
        return picked
    return chosen if all_runs else latest_run_per_command(runs, commands=commands)


def rows_of_runs(rows: DataFrame, runs: DataFrame, *, dataset_name: str | None = None) -> DataFrame:
    """Usage or failure rows of the selected runs (partition pruning when stored by run id)."""
    if dataset_name is not None:
        rows = rows.where(F.col("dataset_name") == dataset_name)
    return rows.join(runs.select("run_id"), "run_id", "left_semi")


def run_counts(pages: DataFrame, failures: DataFrame, usage: DataFrame, keys=("run_id",)) -> DataFrame:
    """Per run: processed and skipped pages, failure rows and failed pages, calls and tokens, exit class."""
    keys = list(keys)
    live = ~F.col("cached")

    def tokens(when: Column) -> Column:
        return F.sum(F.when(when, F.coalesce("input_tokens", F.lit(0)) + F.coalesce("output_tokens", F.lit(0))).otherwise(0))

    p = pages.groupBy(*keys).agg(
        F.count_if(F.col("status") == "processed").alias("pages_processed"),
        F.count_if(F.col("status") == "skipped").alias("pages_skipped"),
    )
    f = (
        failures.groupBy(*keys, "page_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys)
        .agg(F.sum("n").alias("failure_rows"), F.count(F.lit(1)).alias("pages_failed"))
    )
    u = usage.groupBy(*keys).agg(
        F.count_if(live).alias("live_calls"),
        F.count_if(F.col("cached")).alias("cached_calls"),
        tokens(live).alias("live_tokens"),
        tokens(F.col("cached")).alias("cached_tokens"),
    )
    joined = p.join(f, keys, "full").join(u, keys, "full")
    counted = joined.select(
        *keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in joined.columns if c not in keys]
    )
    return counted.withColumn(
        "status",
        F.when(F.col("pages_failed") == 0, "success")
        .when(F.col("pages_processed") + F.col("pages_skipped") > 0, "partial_success")
        .otherwise("failed"),
    )


FAILURE_COLUMNS = [
    "run_id", "document_id", "page_id", "space_key", "title", "stage", "error_type", "message",
    "retryable", "attempts", "suggested_action",
]


def failure_rows(
    rejected: DataFrame,
    *,
    run_id: str,
    stage: str,
    error_type: Column | str,
    message: Column | str,
    retryable: Column | bool = False,
    attempts: int = 1,
    suggested_action: str | None = None,
) -> DataFrame:
    """Rows of the failures table from a job's rejected branch (needs the page keys and title)."""

    def col(v) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return rejected.select(
        F.lit(run_id).alias("run_id"), "document_id", "page_id", "space_key", "title",
        F.lit(stage).alias("stage"), col(error_type).alias("error_type"), col(message).alias("message"),
        col(retryable).alias("retryable"), F.lit(attempts).alias("attempts"),
        F.lit(suggested_action).cast("string").alias("suggested_action"),
    )


def warning_rows(df: DataFrame, column: str, *, run_id: str, stage: str) -> DataFrame:
    """One row per entry of the array ``column``."""
    # an inner explode makes Spark compute the array a second time, in a filter on its size
    told = df.select(
        F.lit(run_id).alias("run_id"), "document_id", "page_id", "space_key", "title",
        F.posexplode_outer(column).alias("_pos", "warning_type"),
    )
    return told.where("_pos is not null").drop("_pos").select("*", F.col("warning_type").alias("message"), F.lit(stage).alias("stage"))
