"""Ranked lexical search with Block-Max MaxScore.

``build_index`` cuts every text into terms and writes an inverted index over all documents. Each map task makes shards
of bounded size from the rows that it reads; a term's postings in a shard lie in blocks of 128, compressed, each with
the largest part of a score that a posting in it can give. Nothing is shuffled for it.

``search`` counts the documents of the query terms over all shards, then sends the blocks of these terms to one task per
shard. There a query's lists are ordered by their bounds: those whose bounds together stay below the score
to beat cannot bring up a document alone. Candidates come from the other, essential lists. They are then taken through the
remaining lists from the highest bound down; the maximum of the block in which a candidate would stand rejects it
before the block is decompressed. The score to beat is the lowest of a heap that a task carries from shard to shard, or
a higher one reached by enough candidates already. The heaps of the tasks are merged by a window with a rank limit.

Scores are 64-bit integers: the sum over the query's terms, repeats included, of
``w * ((1000000000 * tf) div (1000 * tf + 12 * m))`` with ``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and
``m = 75 + (25 * n * N) div L``. Pruning compares bounds strictly, so the results are those of a full search.

Queries are collected in blocks of at most about ``QUERY_BYTES`` of terms, whose size is summed beforehand; more
queries are more blocks.

Defined results: null and empty texts have no terms and are never found; repeated documents are ranked each; equal scores
go by ascending id, null ids last; query rows equal in id and text are one query, rows of one id
with different texts are ranked each; queries without a known term give no rows; empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from corpuswright.llm.chosen_path import _groups
from corpuswright.session import cut_lineage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK = 128  # postings of a block
SHARD_BYTES = 16 << 20  # text of a shard
QUERY_BYTES = 8 << 20  # terms of a block of queries

# bytes of a text in UTF-8 as its terms are made of them: ASCII capitals in lower case, other ASCII signs blank
_AS_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

POSTINGS = "shard long, term string, block int, last int, n int, top long, data binary"


@dataclass
class SearchIndex:
    """Blocks of postings (a row without term holds a shard's documents), and the size of the corpus."""

    rows: DataFrame
    documents: int
    terms: int


def terms_of(text: Column) -> Column:
    """Array of the terms of ``text``, in order and with repeats."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)), F.array().cast("array<string>"))


def split_terms(text: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """Terms of a text in UTF-8, about ``step`` bytes at a time."""
    blanked, at = text.translate(_AS_TERMS), 0
    while at < len(blanked):
        to = blanked.find(b" ", at + step)
        to = len(blanked) if to < 0 else to
        yield blanked[at:to].split()
        at = to


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in seven bits a byte, the last byte of each below 128, and where each starts."""
    size = 1 + sum((values >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(5):
        here = np.flatnonzero(size > k)
        out[start[here] + k] = (values[here] >> 7 * k & 127) | np.where(size[here] > k + 1, 128, 0)
    return out, start


def unpack_numbers(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    starts = np.append(0, ends[:-1] + 1)[: len(ends)]
    values = (raw[starts] & 127).astype(np.int64)
    for k in range(1, 5):
        here = np.flatnonzero(ends - starts >= k)
        values[here] |= (raw[starts[here] + k] & 127).astype(np.int64) << 7 * k
    return values


def part_of_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class _ShardBuilder:
    """Gathers documents until the shard is full, then gives its rows."""

    def __init__(self, documents: int, terms: int):
        self.documents, self.terms = documents, terms
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.ids: list = []
        self.lengths: list[int] = []
        self.words: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, text: bytes) -> None:
        found = [np.fromiter(map(self.numbers.__getitem__, part), np.int32, len(part)) for part in split_terms(text)]
        n = sum(map(len, found))
        if n:
            self.ids.append(doc_id)
            self.lengths.append(n)
            self.words += found
            self.size += len(text) + 64

    def rows(self, shard: int, schema: pa.Schema, step: int = 50_000) -> Iterator[pa.RecordBatch]:
        """The row of the documents, in the order of their ids, then the blocks in the order of terms."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        n = np.array(self.lengths, np.int64)
        m = np.empty(len(n), np.int64)
        m[place] = 75 + 25 * n * self.documents // self.terms
        first = [[shard], [None], [-1], [-1], [len(order)], [0], [m.tobytes()], [[self.ids[i] for i in order]]]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(first, schema, strict=True)], schema=schema)

        terms = pa.array(list(self.numbers), pa.binary())
        by_term = pc.sort_indices(terms)
        rank = np.empty(len(terms), np.int64)
        rank[by_term.to_numpy()] = np.arange(len(terms))
        pairs = rank[np.concatenate(self.words)] << 32
        pairs |= np.repeat(place, n)
        pairs.sort()
        at = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        tf = np.diff(np.append(at, len(pairs)))
        term, doc = pairs[at] >> 32, pairs[at] & 0xFFFFFFFF
        del pairs
        # a block starts with a term and after every BLOCK postings of it
        fresh = np.append(True, term[1:] != term[:-1])
        begins = np.flatnonzero(fresh)
        within = np.arange(len(term)) - np.repeat(begins, np.diff(np.append(begins, len(term))))
        edge = np.flatnonzero(within % BLOCK == 0)
        size = np.diff(np.append(edge, len(term)))
        top = np.maximum.reduceat(part_of_score(tf, m[doc]), edge)
        gaps = np.diff(doc, prepend=0)
        gaps[edge] = doc[edge]
        values = np.empty(2 * len(doc), np.int64)
        values[::2], values[1::2] = gaps, tf
        data, starts = pack_numbers(values)
        starts = np.append(starts[2 * edge], len(data)).astype(np.int32)
        names = terms.take(by_term).cast(pa.string())
        for a in range(0, len(edge), step):
            b = min(a + step, len(edge))
            e = edge[a:b]
            blobs = data[starts[a] : starts[b]]
            columns = {
                "shard": np.full(b - a, shard),
                "term": names.take(pa.array(term[e])),
                "block": (within[e] // BLOCK).astype(np.int32),
                "last": doc[e + size[a:b] - 1].astype(np.int32),
                "n": size[a:b].astype(np.int32),
                "top": top[a:b],
                "data": pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(starts[a : b + 1] - starts[a]), pa.py_buffer(blobs.copy())]),
                "doc_ids": pa.nulls(b - a, schema.field("doc_ids").type),
            }
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) if isinstance(v, np.ndarray) else v for v, f in zip(columns.values(), schema, strict=True)], schema=schema)


def build_index(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> SearchIndex:
    """Index of all rows of ``docs``, written to the shared folder. Runs two jobs."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    n = F.coalesce(F.regexp_count("text", F.lit(TERM)), F.lit(0)).cast("long")
    size = rows.select(n.alias("n")).agg(F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    documents, terms = size
    fields = _parse_datatype_string(POSTINGS).fields
    schema = StructType([*fields, StructField("doc_ids", _parse_datatype_string(f"array<{docs.schema[doc_id].dataType.simpleString()}>"))])
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder, shard = _ShardBuilder(documents, terms), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc, body in zip(batch.column(0), batch.column(1), strict=True):
                builder.add(doc.as_py(), body.as_py() or b"")
                if builder.size >= shard_bytes:
                    yield from builder.rows(shard, arrow_schema)
                    builder.clear()
                    shard += 1
        if builder.ids:
            yield from builder.rows(shard, arrow_schema)

    packed = rows.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)
    return SearchIndex(cut_lineage(packed), documents, terms)


class Shard:
    """Blocks of one shard; ``unpacked`` counts the blocks that had to be decompressed."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        self.doc_ids = rows.column("doc_ids")[0].as_py()
        self.m = np.frombuffer(rows.column("data")[0].as_py(), np.int64)
        rows = rows.slice(1)
        terms = rows.column("term").to_numpy()
        self.last, self.n, self.top = (rows.column(c).to_numpy() for c in ("last", "n", "top"))
        self.data = rows.column("data").to_pylist()
        edges = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
        ends = np.append(edges[1:], len(terms))
        self.lists = {terms[a]: (a, b) for a, b in zip(edges.tolist(), ends.tolist(), strict=True)}
        self.bounds = dict(zip(self.lists, np.maximum.reduceat(self.top, edges).tolist() if len(edges) else [], strict=True))
        self.whole: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.unpacked = 0

    def postings(self, blocks: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the blocks and their parts of the score, decompressed."""
        self.unpacked += len(blocks)
        values = unpack_numbers(np.frombuffer(b"".join([self.data[b] for b in blocks]), np.uint8))
        gaps, tf = values[::2], values[1::2]
        n = self.n[blocks]
        sums, begin = np.cumsum(gaps), np.cumsum(n) - n
        docs = sums - np.repeat(sums[begin] - gaps[begin], n)
        return docs, part_of_score(tf, self.m[docs])

    def whole_list(self, term: str) -> tuple[np.ndarray, np.ndarray]:
        """A list that is essential for one query of the block is likely so for others, so it is kept."""
        if term not in self.whole:
            self.whole[term] = self.postings(list(range(*self.lists[term])))
        return self.whole[term]

    def best(self, weights: dict[str, int], k: int, to_beat: int) -> list[tuple[int, int]]:
        """(score, document) of the up to ``k`` best with a score above 0 and not below ``to_beat``, best first."""
        held = sorted((w * self.bounds[t], t) for t, w in weights.items() if w > 0 and t in self.lists)
        reach = np.cumsum([b for b, _ in held])
        optional = int(np.searchsorted(reach, to_beat, "left"))  # reach[optional - 1] < to_beat
        if optional == len(held):
            return []
        score = np.zeros(len(self.m), np.int64)
        for _, term in held[optional:]:
            docs, parts = self.whole_list(term)
            score[docs] += weights[term] * parts
        ahead = np.flatnonzero(score)
        parts_of = np.zeros(len(self.m), np.int64)
        for i in range(optional - 1, -1, -1):
            bound, term = held[i]
            now = score[ahead]
            if len(ahead) > k:
                to_beat = max(to_beat, int(np.partition(now, len(now) - k)[len(now) - k]))
            ahead = ahead[now + int(reach[i]) >= to_beat]
            if not len(ahead):
                return []
            first, end = self.lists[term]
            block = np.searchsorted(self.last[first:end], ahead) + first
            inside = block < end
            limit = np.where(inside, weights[term] * self.top[np.minimum(block, end - 1)], 0)
            stays = score[ahead] + limit + (int(reach[i - 1]) if i else 0) >= to_beat
            ahead, wanted = ahead[stays], np.unique(block[stays & inside])
            if not len(wanted):
                continue
            docs, parts = self.whole[term] if term in self.whole else self.postings(wanted.tolist())
            parts_of[docs] = parts
            score[ahead] += weights[term] * parts_of[ahead]
            parts_of[docs] = 0
        now = score[ahead]
        fits = np.flatnonzero(now >= max(to_beat, 1))
        best = fits[np.lexsort((ahead[fits], -now[fits]))[:k]]
        return list(zip(now[best].tolist(), ahead[best].tolist(), strict=True))


class Heaps:
    """The best documents of each query over the shards of a task."""

    def __init__(self, queries: list[tuple], k: int):
        self.queries, self.k = queries, k
        self.held: list[list[tuple]] = [[] for _ in queries]

    def take(self, shard: Shard) -> None:
        for q, (_, weights) in enumerate(self.queries):
            held = self.held[q]
            found = shard.best(weights, self.k, held[-1][1] if len(held) == self.k else 0)
            if found:
                ids = shard.doc_ids
                held += [(ids[doc], score) for score, doc in found]
                held.sort(key=lambda x: (-x[1], x[0] is None, x[0]))
                del held[self.k :]


def _query_blocks(index: SearchIndex, queries: DataFrame, item_id: str, text: str) -> Iterator[tuple[DataFrame, list[tuple]]]:
    """For each block of queries, its terms as a table for a broadcast, and its queries as (item, weights by term)."""
    rows = queries.select(F.col(item_id).alias("item"), F.col(text).cast("string").alias("text"))
    rows = rows.select("item", F.md5(F.coalesce("text", F.lit(""))).alias("q"), F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"), "text")
    times = F.size(F.filter(terms_of(F.col("text")), lambda x: x == F.col("term")))
    rows = cut_lineage(rows.dropDuplicates(["item", "q", "term"]).select("item", "q", "term", times.cast("long").alias("times")))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0]
    blocks = -(-size // QUERY_BYTES)
    for b in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("item", "q"), F.lit(blocks)) == b)
        terms = block.select("term").distinct()
        found = index.rows.where("term is not null").select("term", "n").join(F.broadcast(terms), "term").groupBy("term").agg(F.sum("n").alias("df"))
        weight = F.floor(1000 * F.log((F.lit(2.0) * index.documents + 2) / (2 * F.col("df") + 1))).cast("long")
        asked: dict[tuple, dict[str, int]] = defaultdict(dict)
        for r in block.join(found, "term").select("item", "q", "term", (weight * F.col("times")).alias("w")).collect():
            asked[r.item, r.q][r.term] = r.w
        yield terms, [(item, weights) for (item, _), weights in asked.items()]


def search(index: SearchIndex, queries: DataFrame, *, item_id: str = "item_id", text: str = "text", k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each query. Runs jobs for the query terms."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = queries.sparkSession
    doc_type = index.rows.schema["doc_ids"].dataType.elementType.simpleString()
    schema = _parse_datatype_string(f"query long, item_id {queries.schema[item_id].dataType.simpleString()}, doc_id {doc_type}, score long")
    arrow_schema = to_arrow_schema(schema)
    found = []
    for number, (terms, asked) in enumerate(_query_blocks(index, queries, item_id, text)):
        shared = spark.sparkContext.broadcast(asked)
        blocks = index.rows.join(F.broadcast(terms), "term", "left_semi").unionByName(index.rows.where("term is null"))
        # a whole shard meets in one task, the row of its documents first
        dealt = blocks.repartition("shard").sortWithinPartitions("shard", F.col("term").asc_nulls_first(), "block")

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            heaps = Heaps(shared.value, k)
            for rows in _groups(batches, "shard"):
                heaps.take(Shard(rows))
            out = [(number << 32 | q, asked[0], doc, score) for q, asked in enumerate(heaps.queries) for doc, score in heaps.held[q]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow_schema, strict=True)], schema=arrow_schema)

        found.append(dealt.select(*index.rows.columns).mapInArrow(run, schema))
    if not found:
        return spark.createDataFrame([], schema).select("item_id", F.lit(1).alias("rank"), "doc_id", "score")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    merged = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, queries: DataFrame, *, k: int = 20, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Index ``docs`` (doc_id, text) and rank them for each of ``queries`` (item_id, text)."""
    return search(build_index(docs, shard_bytes=shard_bytes), queries, k=k)
