"""Fill-in-middle: brute force over whole texts, exact restoration, odd rows."""

import hashlib
import re

import pytest

pytest.importorskip("corpuswright.llm")

from corpuswright.llm.fill_middle import fill_in_middle, output_texts, restore  # noqa: E402


def expected(doc_id, text):
    """The contract, read directly: units as a list, sections joined."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(texts):
    out = []
    for doc, text in texts:
        n, form, p, m, output = expected(doc, text)
        out.append((doc, n, form, p, m, sha(output), sha(text or "")))
    return sorted(out, key=str)


ODD = [
    None, "", "a", " ", "\n\n", "abc", "naïve café – 東京 🙂🙂 x", "a<P>b", "a<S>", "<M>", "<P", "S>x", "<<S", "ends with <", "ends with <S",
    "x" * 70_000, "one two\n" * 3000, "🙂" * 5000, "é" * 4096 + "abc" * 3,
]


def test_odd_texts(spark):
    texts = [(i * 1000 + j, t) for i, t in enumerate(ODD) for j in range(12)] + [(None, "no id"), (None, None)]
    docs = spark.createDataFrame([(t, d, "x", b"y") for d, t in texts], "text string, doc_id long, form string, key binary")
    assert sorted(map(tuple, fill_in_middle(docs).collect()), key=str) == rows_of(texts)
    small = fill_in_middle(docs, piece_units=3).collect()  # many pieces, the same digests
    assert sorted(map(tuple, small), key=str) == rows_of(texts)


def test_repeated_rows_and_empty_table(spark):
    texts = [(7, "the same words " * 50)] * 5 + [(7, "other words"), (8, "the same words " * 50)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(map(tuple, fill_in_middle(docs, piece_units=8).collect()), key=str) == rows_of(texts)
    assert fill_in_middle(docs.where("doc_id < 0")).collect() == []


def test_outputs_and_their_restoration(spark):
    texts = [(i, t) for i, t in enumerate(ODD * 4)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in output_texts(docs, piece_units=5).collect()}
    assert len(got) == len(texts) and {r.form for r in got.values()} == {"plain", "psm", "spm"}
    for doc, text in texts:
        assert (got[doc].form, got[doc].output) == (expected(doc, text)[1], expected(doc, text)[4])
        assert restore(got[doc].output, got[doc].form) == (text or "")


def test_text_crosses_one_exchange(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
