"""Packing: every id in one piece, gapless sequences, checksums against the tokenizer itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("corpuswright.llm")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from corpuswright.llm.packing import Encoder, pack  # noqa: E402

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def verify(rows, texts, window):
    """``texts`` maps unique ids to texts; returns the number of padded ids."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, at = ids_of(texts[doc]), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    padded = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded


def test_encoder_equals_the_tokenizer():
    encoder = Encoder(None)
    texts = ["", "It's  a\tTest\n\nΣΑΣ ΟΔΟΣ, naïve é ́x 12345", "a<|endoftext|> b <|startoftext|>c", "x y z\x0bq\x1cr", "İstanbul ﬁ 東京 🙂🙂 don't we'll"]
    for t in texts:
        assert encoder.ids(t).tolist() == TOKENIZER.encode(t, add_special_tokens=False).ids


def test_plain_texts_are_cut_together():
    encoder, made = Encoder(None), []
    make = encoder.words.make
    encoder.words.make = lambda word: made.append(word) or make(word)
    texts = ["Wörter, WÖRTER wörter.", "", "  ÀÉß-ÿÞ x2y 12345 <a|b>\r\n", "don't", "x2y\t(wörter)", "\n", "× ÷ ª", "11", "1"]
    for t, ids in zip(texts, encoder.ids_of_all(texts), strict=True):
        assert ids.tolist() == TOKENIZER.encode(t, add_special_tokens=False).ids
    assert len(made) == len(set(made)) and made.count("wörter".encode("latin-1")) == 1
    assert encoder.ids_of_all([]) == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert verify(pack(docs).collect(), texts, 2048) == 0
    assert verify(pack(docs, window=64, shard_tails=20).collect(), texts, 64) == 0


def test_odd_rows(spark):
    texts = {1: None, 2: "", 3: "word " * 9000, 4: "a b c", 5: "a b c", 6: "z" * 5000}
    docs = spark.createDataFrame([(i, t, 7) for i, t in texts.items()], "doc_id long, text string, start long")
    assert verify(pack(docs).collect(), texts, 2048) == 0
    twice = pack(docs.where("doc_id = 4").unionAll(docs.where("doc_id = 4"))).collect()
    assert sum(r.length for r in twice) == 2 * len(ids_of("a b c"))
    assert pack(docs.where("doc_id < 0")).count() == 0


def test_neighbours_share_a_window(spark):
    groups = range(4)
    names = ["kelp", "zinc", "opal", "moss"]
    rows = [(g * 100 + i, " ".join([names[g]] * 20 + ["common text"] * (3 + i % 5))) for g in groups for i in range(40)]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string"), window=256).collect()
    topics = defaultdict(set)
    for r in got:
        topics[r.sequence_id].add(r.doc_id // 100)
    assert sum(len(t) for t in topics.values()) / len(topics) < 1.7


def test_other_vocabularies_give_their_own_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    texts = {1: "Hello World, it is 2024", 2: "a  b\n\n c<|endoftext|>", 3: "", 4: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in pack(docs, vocabulary=path).collect():
        ids = [*other.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
