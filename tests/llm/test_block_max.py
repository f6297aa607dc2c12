"""Ranked search: equal to scoring every document for every query, while blocks stay compressed."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("corpuswright.llm")

from corpuswright.llm import block_max  # noqa: E402
from corpuswright.llm.block_max import Heaps, Shard, _ShardBuilder, build_index, pack_numbers, ranked_search, search, split_terms, unpack_numbers  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k=20):
    """The contract read directly: every query against every document."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, length, df = len(counted), sum(sum(c.values()) for _, c in counted), Counter()
    for _, c in counted:
        df.update(c.keys())
    out = []
    for item, text in dict.fromkeys(items):
        asked = Counter(t for t in terms(text) if t in df)
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in asked}
        found = []
        for d, c in counted:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // length
            score = sum(times * weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, times in asked.items() if t in c)
            if score > 0:
                found.append((d, score))
        found.sort(key=lambda x: (-x[1], x[0] is None, x[0]))
        out += [(item, r, d, s) for r, (d, s) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_terms_of_bytes():
    texts = ["", "It's A_b c-D É é 東京 x1２\x00y\x7fz{w}", "ab " * 1000]
    for t in texts:
        assert [w.decode() for part in split_terms(t.encode(), step=7) for w in part] == terms(t)


def test_numbers_round_trip():
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 2**21 - 1, 2**21, 2**28, 2**33, 5])
    raw, starts = pack_numbers(values)
    assert unpack_numbers(raw).tolist() == values.tolist() and starts[3] == 3
    assert unpack_numbers(raw[:0]).tolist() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    expected = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert expected and rows(ranked_search(docs, items)) == expected
    assert rows(ranked_search(docs, items, shard_bytes=20_000)) == expected  # many shards


ODD = [
    (1, None), (2, ""), (3, "- . !"), (4, "kelp"), (5, "kelp"), (None, "kelp"), (5, "kelp"), (6, "KELP kelp É é"), (7, "é zinc 東京"),
    (8, "common " * 20_000 + "kelp"), (9, "common zinc"), (10, "common"), (11, "common opal opal"),
]


def test_odd_rows_ties_and_repeats(spark):
    items = [(1, "kelp Kelp KELP"), (2, "É é 東京"), (3, None), (4, ""), (5, "unknown words"), (None, "zinc opal common"), (1, "zinc"), (1, "zinc")]
    docs = spark.createDataFrame([(t, d, 5, "x") for d, t in ODD], "text string, doc_id long, score int, term string")
    asked = spark.createDataFrame([(t, i, 1) for i, t in items], "text string, item_id long, rank int")
    assert rows(ranked_search(docs, asked)) == brute(ODD, items)
    assert rows(ranked_search(docs, asked, k=2, shard_bytes=1)) == brute(ODD, items, 2)  # a shard for each document


def test_empty_tables(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "kelp")], "item_id int, text string")
    assert rows(ranked_search(docs.where("false"), asked)) == []
    assert rows(ranked_search(docs, asked.where("false"))) == []
    assert ranked_search(docs, asked.where("false")).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_queries_and_text_ids(spark, monkeypatch):
    random.seed(3)
    words = [f"w{i}" for i in range(300)]
    docs = [(f"d{i}", " ".join(random.choices(words, k=random.randint(1, 80)))) for i in range(600)]
    items = [(f"q{i}", " ".join(random.choices(words, k=6))) for i in range(30)]
    monkeypatch.setattr(block_max, "QUERY_BYTES", 2000)
    index = build_index(spark.createDataFrame(docs, "doc_id string, text string"))
    assert rows(search(index, spark.createDataFrame(items, "item_id string, text string"), k=5)) == brute(docs, items, 5)


def test_pruning_leaves_blocks_compressed():
    random.seed(4)
    words = [f"w{i}" for i in range(2000)]
    docs = [(i, "the " * random.randint(1, 5) + " ".join(random.choices(words, k=60))) for i in range(4000)]
    docs += [(9000 + i, "rare stone " * (i + 1) + "the") for i in range(25)]
    length = sum(len(terms(t)) for _, t in docs)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(block_max.POSTINGS + ", doc_ids array<long>"))
    builder = _ShardBuilder(len(docs), length)
    for d, t in docs:
        builder.add(d, t.encode())
    shard = Shard(pa.Table.from_batches(builder.rows(1, schema)))
    df = Counter(t for _, text in docs for t in set(terms(text)))
    query = {t: math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) for t in ("rare", "stone", "the")}
    assert query["the"] == 0  # a word of every document has no weight
    query["the"] = 1
    heaps = Heaps([(1, query)], 20)
    heaps.take(shard)
    first, end = shard.lists["the"]
    before = shard.unpacked
    heaps.take(shard)  # now there is a score to beat, and "the" is not essential
    assert end - first > 30 and shard.unpacked == before
    fresh = Shard(pa.Table.from_batches(builder.rows(1, schema)))
    assert fresh.best(query, 20, heaps.held[0][-1][1])
    assert 0 < fresh.unpacked <= 4  # the blocks of the two rare words, and the one of "the" that holds these documents
