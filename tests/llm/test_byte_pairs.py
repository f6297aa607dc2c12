"""Byte-pair encoding: equal to the tokenizers library on whole tables, odd texts and every kind of character."""

import hashlib
import json
import random

import numpy as np
import pytest

pytest.importorskip("corpuswright.llm")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from corpuswright.llm import byte_pairs  # noqa: E402
from corpuswright.llm.byte_pairs import Encoder, PairTree, Vocabulary, decode, decode_ids, encode, merge_rows, round_trip  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
WORDS = Vocabulary(None)

ODD = [
    None, "", " ", "a", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "<|endoftext", "don't WE'LL 's''t", "  two  blanks \n\n\tline  ",
    "z" * 5000, "ab" * 3000, " " * 3000, "é" * 2000, "naïve café – 東京 🙂🙂 ½ ² x٣", "\x00\x1c\x85\xa0　", "x" * 62 + " " + "y" * 63 + " " + "w" * 64 + " " + "q" * 65,
    "word and word " * 30_000,
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def row_of(doc, text):
    ids = ids_of(text)
    back = LIBRARY.decode(ids, skip_special_tokens=False)
    return doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_odd_texts():
    assert [x.tolist() for x in Encoder(WORDS).encode(ODD)] == [ids_of(t) for t in ODD]


def test_every_character_below_u3000():
    texts = [f"a{chr(c)}b 1{chr(c)}2  {chr(c)}{chr(c)} .{chr(c)}." for c in range(0x3000)]
    assert [x.tolist() for x in Encoder(WORDS).encode(texts)] == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_random_texts_and_a_small_memory(monkeypatch):
    random.seed(5)
    texts = ["".join(random.choices("ab'st re  \n\té東🙂12.,-_", k=random.randint(0, 200))) for _ in range(1500)]
    encoder = Encoder(WORDS, remembered=50)
    monkeypatch.setattr(byte_pairs, "RUN", 70)  # texts of many runs, batches of few words
    assert [x.tolist() for x in encoder.encode(texts)] == [ids_of(t) for t in texts]


def test_both_trees_merge_alike():
    random.seed(6)
    words = ["".join(random.choices("thea n", k=random.randint(1, 30))).encode() for _ in range(500)]
    sizes = np.array([len(w) for w in words])
    symbols = np.zeros((len(words), 32), np.int64)
    for r, w in enumerate(words):
        symbols[r, : len(w)] = WORDS.of_byte[list(w)]
    ids, n = merge_rows(symbols, sizes, WORDS.merges)
    for w, row in zip(words, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert PairTree(WORDS.of_byte[list(w)].tolist(), WORDS.merges.rank_of).merged(WORDS.merges.made) == row.tolist()


def test_ranks_of_pairs():
    merges = WORDS.merges
    keys = np.array(list(merges.rank_of))
    assert merges.rank(keys >> 32, keys & 0xFFFFFFFF).tolist() == list(range(len(keys)))
    random.seed(8)
    left, right = (np.array([random.randrange(50_000) for _ in range(20_000)]) for _ in range(2))
    assert merges.rank(left, right).tolist() == [merges.rank_of.get(k, -1) for k in (left << 32 | right).tolist()]


def test_decoding_any_ids():
    random.seed(7)
    rows = [[random.randrange(50_257) for _ in range(random.randint(0, 40))] for _ in range(500)]
    got = decode_ids(np.array(sum(rows, [])), np.array(list(map(len, rows))), WORDS)
    assert got == [LIBRARY.decode(r, skip_special_tokens=False) for r in rows]
    assert decode_ids(np.array([-1, 60_000, 64]), np.array([3]), WORDS) == [LIBRARY.decode([64])]


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):
        Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    told = json.load(open(PATH))
    told["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "v.json").write_text(json.dumps(told))
    with pytest.raises(ValueError):
        Vocabulary(str(tmp_path / "v.json"))


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, round_trip(docs).collect())) == sorted(row_of(*t) for t in texts)


def test_columns_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(7, t, "x", 3) for t in ODD] + [(None, "no id", None, None)] * 2, "doc_id long, text string, ids string, n_tokens int")
    expected = [row_of(7, t) for t in ODD] + [row_of(None, "no id")] * 2
    assert sorted(map(tuple, round_trip(docs).collect()), key=str) == sorted(expected, key=str)
    encoded = encode(docs)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"] and encoded.schema["ids"].dataType.simpleString() == "array<int>"
    back = decode(encoded.withColumn("text", encoded.n_tokens)).select("text").collect()
    assert sorted(r.text for r in back) == sorted([*(t or "" for t in ODD), "no id", "no id"])
    assert decode(spark.createDataFrame([(None,), ([],), ([64, None],)], "ids array<int>")).select("text").collect() == [("",), ("",), ("a",)]
    assert round_trip(docs.where("doc_id < 0")).collect() == []
