"""Document profile: keys, text statistics, similarity signatures.

Input: a *pages* table (see ``corpuswright.schemas.PAGES``). Text is read once, row by row; only
signatures and counts leave the scan stage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx

_TOKENS = re.compile("[a-z0-9]{3,}")
# one counter for bit k and one for bit k + 32 share a long
_PAIR = 0x0000000100000001


def document_key(pages: DataFrame, *, id_prefix: str = "doc") -> DataFrame:
    """Add ``document_id`` and ``source_content_hash`` (first non-empty of the four hashes)."""
    hashes = [
        F.nullif(F.col("content_hashes")[name], F.lit(""))
        for name in ("markdown_sha256", "text_sha256", "storage_sha256", "export_view_sha256")
    ]
    return pages.withColumns(
        {
            "document_id": F.concat_ws(":", F.lit(id_prefix), "space_key", "page_id"),
            "source_content_hash": F.concat(
                F.lit("sha256:"), F.coalesce(*hashes, F.lit("unknown"))
            ),
        }
    )


def text_stats(pages: DataFrame) -> DataFrame:
    """Add both word counts, the heading list and count, the link count."""
    return pages.withColumns(
        {
            "score_words": tx.word_count(F.col("text")),
            "word_count": tx.token_count(F.col("text")),
            "headings": tx.extract_headings(F.col("markdown")),
            "link_count": F.size(tx.coalesce_array(F.col("links"), _LINK)),
        }
    ).withColumn("heading_count", F.size("headings"))


_LINK = "struct<type:string,href:string,text:string,target_title:string>"


def content_availability(pages: DataFrame) -> DataFrame:
    """``empty`` (marker in the body), ``thin`` (fewer than 80 words) or ``normal``; words counted by ``text_stats`` are taken."""
    body = F.lower(tx.strip_front_matter(F.col("markdown")))
    words = F.col("score_words") if "score_words" in pages.columns else tx.word_count(F.col("text"))
    return pages.withColumn(
        "content_availability",
        F.when(body.contains(fv.EMPTY_BODY_MARKER), F.lit("empty"))
        .when(words < 80, F.lit("thin"))
        .otherwise(F.lit("normal")),
    )


def _bit_counts(texts: list, digests: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each lower-case text, and 32 longs with the ones of bits k and k + 32 of their digests."""
    found = [_TOKENS.findall(t) if t else [] for t in texts]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    sums = np.zeros((32, len(found)), np.int64)
    flat = list(chain.from_iterable(found))
    if flat:
        for tok in set(flat).difference(digests):
            digests[tok] = int.from_bytes(sha256(tok.encode()).digest()[:8], "big", signed=True)
        bits = np.fromiter(map(digests.__getitem__, flat), np.int64, len(flat)).view(np.uint64)
        some = sizes > 0
        starts = (np.cumsum(sizes) - sizes)[some]
        for k in range(32):
            sums[k, some] = np.add.reduceat(bits >> np.uint64(k) & np.uint64(_PAIR), starts).view(np.int64)
    return sizes, sums


def _simhashes(said: DataFrame, keys: list[str], *others: Column) -> DataFrame:
    """(keys, simhash, others) of rows (keys, low, ...); ``others`` are further aggregates of the same rows.

    The tokens of the lower-case text ``low`` are counted in the scan task, which leaves a row of 33 numbers per text;
    only these are shuffled. Rows of one key count together; a key without a token gets 16 zeros.
    """
    names = [c for c in said.columns if c != "low"]
    rest = said.select(*names, "low")
    schema = T.StructType([*(said.schema[c] for c in names), *(T.StructField(c, T.LongType()) for c in ["one", *[f"b{k}" for k in range(32)]])])
    out_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests: dict[str, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if len(digests) > 500_000:
                    digests.clear()
                sizes, sums = _bit_counts(part.column(len(names)).to_pylist(), digests)
                columns = [*part.columns[: len(names)], pa.array(sizes), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out_schema, strict=True)], schema=out_schema)

    sums = [F.sum(f"b{k}").alias(f"s{k}") for k in range(32)]
    counted = rest.mapInArrow(run, schema).groupBy(*keys).agg(F.sum("one").alias("n"), *sums, *others)
    low, high = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    mask = F.lit(0xFFFFFFFF).cast("bigint")
    for k in range(32):
        ones_low = F.col(f"s{k}").bitwiseAND(mask)
        ones_high = F.shiftrightunsigned(f"s{k}", 32)
        low = low + F.when(ones_low * 2 >= F.col("n"), F.lit(1 << k).cast("bigint")).otherwise(0)
        high = high + F.when(ones_high * 2 >= F.col("n"), F.lit(1 << k).cast("bigint")).otherwise(0)
    value = F.format_string("%08x%08x", high, low)
    return counted.withColumn("simhash", F.when(F.col("n") == 0, F.lit("0" * 16)).otherwise(value)).drop(
        "n", *[f"s{k}" for k in range(32)]
    )


def simhash64(docs: DataFrame, text: Column | str, *, key: str = "document_id") -> DataFrame:
    """(key, simhash): weighted 64-bit simhash over SHA-256 of the tokens, as 16 hex digits.

    A document without a token gets 16 zeros.
    """
    column = F.col(text) if isinstance(text, str) else text
    return _simhashes(docs.select(key, F.lower(column).alias("low")), [key])


def signatures(pages: DataFrame) -> DataFrame:
    """(document_id, text_simhash, heading_simhash, heading_count) from one pass over text and Markdown.

    Text and headings are rows of one list, each with the part it is, and one aggregation makes both signatures.
    """
    heads = pages.select("document_id", "text", tx.extract_headings(F.col("markdown")).alias("headings"))
    parts = F.array(
        *[
            F.struct(F.lit(part).alias("part"), F.lower(said).alias("low"), count.alias("count"))
            for part, said, count in (
                ("text", F.col("text"), F.lit(0)),
                ("headings", F.array_join("headings", " "), F.size("headings")),
            )
        ]
    )
    tagged = heads.select("document_id", F.inline(parts))
    found = _simhashes(tagged, ["document_id", "part"], F.max("count").alias("count"))
    of = lambda part, c: F.max(F.when(F.col("part") == part, F.col(c)))
    return found.groupBy("document_id").agg(
        of("text", "simhash").alias("text_simhash"), of("headings", "simhash").alias("heading_simhash"),
        of("headings", "count").alias("heading_count"),
    )
