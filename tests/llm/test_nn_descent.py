"""NN-descent against brute force."""

import math

import numpy as np
import pytest

pytest.importorskip("corpuswright.llm")
from corpuswright.llm.nn_descent import audit, forest_size, near_duplicates  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, root long"


def brute(ids, vectors, cosine=0.95):
    v = np.array([x / np.linalg.norm(x) for x in vectors])
    near = v @ v.T >= cosine
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        low = np.minimum(label, np.where(near, label[None, :], 1 << 60).min(axis=1))
        if (low == label).all():
            return {i: (int(n), int(c), i == c) for i, n, c in zip(ids, near.sum(axis=1), label, strict=True)}
        label = low


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((220, 24))
    dense = rng.standard_normal(24) * 3 + rng.standard_normal((60, 24)) * 0.35
    near = base[:40] + rng.standard_normal((40, 24)) * 0.12
    vectors = np.concatenate([base, dense, near, base[:10], base[10:14] * 3])
    ids = list(range(7, 7 + len(vectors)))
    rows = [(i, v.tolist(), 0) for i, v in zip(ids, vectors, strict=True)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), k=6, leaf=40, block=25).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute(ids, vectors)


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [math.nan, 1.0], 0), (6, [math.inf, 1.0], 0), (7, [1.0, 2.0], 0), (7, [1.0, 2.0], 0), (None, [2.0, 4.0], 0), (8, [1.0], 0)]
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == [(0, 2, 7, False)] + [(i, 0, i, True) for i in range(1, 7)] + [(7, 2, 7, True)] * 2 + [(8, 0, 8, True)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_between_saturated_groups(spark):
    rng = np.random.default_rng(2)
    axes = np.linalg.qr(rng.standard_normal((32, 12)))[0].T
    turn = math.acos(0.96)
    chain = [math.cos(i * turn) * axes[0] + math.sin(i * turn) * axes[1] for i in range(5)]
    centres = [*chain, axes[4], math.cos(turn) * axes[4] + math.sin(turn) * axes[5], axes[8]]
    vectors = np.concatenate([c + rng.standard_normal((16, 32)) * 0.004 for c in centres])
    ids = list(range(len(vectors)))
    rows = [(i, v.tolist(), 0) for i, v in zip(ids, vectors, strict=True)]
    want = brute(ids, vectors)
    assert {c for _, c, _ in want.values()} == {0, 80, 112}
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), k=6, leaf=40, block=25, recall=0.0).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want


def test_audit_sees_pairs_missed_beside_a_hot_group(spark):
    rng = np.random.default_rng(3)
    hot = rng.standard_normal(24) + rng.standard_normal((200, 24)) * 0.01
    base = rng.standard_normal((200, 24))
    v = np.concatenate([hot, base, base + rng.standard_normal((200, 24)) * 0.01])
    rows = [(i, 1, bytearray((x / np.linalg.norm(x)).tobytes())) for i, x in enumerate(v)]
    nodes = spark.createDataFrame(rows, "uid long, weight long, unit binary")
    schema = "uid long, links long, layer int"
    dense, pairs = [(i, 199, 2) for i in range(200)], [(i, 1, 0) for i in range(200, 600)]
    assert audit(nodes, spark.createDataFrame(dense + pairs, schema), 0.95, 512) == 1.0
    assert audit(nodes, spark.createDataFrame(dense + pairs[:40], schema), 0.95, 16) < 0.5
    assert audit(nodes, spark.createDataFrame(dense, schema), 0.95, 512) == 0.0


def test_forest_grows_with_the_table():
    assert forest_size(5_000, 8, 128, 0.95, 0.99) == 8
    for n in (10**6, 10**7):
        together = (1 - math.acos(0.95) / math.pi) ** math.ceil(math.log2(n / 128))
        assert 1 - (1 - together) ** forest_size(n, 8, 128, 0.95, 0.99) >= 0.99
