"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the whitespace-separated words of ``text``; null gives an empty array."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (nested lambdas would compute it per element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that start like ``names`` and clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def row_blocks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Slices (from, to) of rows whose sizes add up to at most ``limit``; a larger row is a slice of its own."""
    at, ends = 0, np.cumsum(sizes)
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield at, to
        at = to


@contextmanager
def arrow_rows(spark, rows: int):
    """Jobs run inside send at most ``rows`` rows of whole texts to Python at once; the session's setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
