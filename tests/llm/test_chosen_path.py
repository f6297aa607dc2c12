"""Chosen-path join against all pairs."""

from collections import Counter

import numpy as np
import pytest

pytest.importorskip("corpuswright.llm")
from corpuswright.llm.chosen_path import one_of_each, set_overlaps, similar_texts  # noqa: E402
from test_pipeline import shingles  # noqa: E402

SCHEMA = "doc_id long, text string, row int, key string"


def brute(rows):
    """Links and class of each row number, ids unique."""
    sets = {i: shingles(t) for i, t in rows}
    links, root = Counter(), {i: i for i in sets}
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = root[a], root[b]
                root = {i: min(x, y) if r in (x, y) else r for i, r in root.items()}
    return {i: (links[i], root[i], root[i] == i) for i in ids}


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA).repartition(5)
    return {r.doc_id: (r.n_links, r.class_id, r.kept) for r in similar_texts(docs, **options).collect()}


def test_groups_copies_and_passages(spark):
    rng = np.random.default_rng(2)
    vocabulary = np.array([f"w{i}" for i in range(500)])
    text = lambda n: list(rng.choice(vocabulary, n))
    base, passage, rows = text(120), text(40), []
    for _ in range(90):  # one dense group, larger than a bucket
        w = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            w[at] = str(rng.choice(vocabulary))
        rows.append(" ".join(w))
    rows += [" ".join(passage + text(60)) for _ in range(60)]  # a shared passage links nothing
    chain = text(200)
    for k in range(12):  # each near the next, ends apart
        rows.append(" ".join(chain[4 * k : 4 * k + 150]))
    rows += [rows[0]] * 5 + ["one two", "one two", "one", "", "", " \n", None, "a b c d e"]
    rows = list(enumerate(rows, start=10))
    assert found(spark, rows, bucket=16) == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, "k")] * 3 + [(None, "a b c d e f", 1, "k"), (5, None, 1, "k"), (5, None, 1, "k")], SCHEMA)
    got = sorted((r.doc_id or 0, r.n_links, r.class_id, r.kept) for r in similar_texts(docs).collect())
    assert got == [(0, 3, 1, False), (1, 3, 1, False), (1, 3, 1, False), (1, 3, 1, True), (5, 0, 5, True), (5, 0, 5, True)]
    left = one_of_each(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 5]
    assert similar_texts(docs.where("doc_id = 9")).count() == 0 and one_of_each(docs.where("doc_id = 9")).count() == 0


def test_overlaps():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (0, 1, 30, 40, 60, 60)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = set_overlaps(sets, columns=16)
    np.fill_diagonal(got, 0)
    assert (got == np.array(want) * (1 - np.eye(6, dtype=int))).all()
