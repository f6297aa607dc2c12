"""Each stage of the pipeline against a brute-force version on its own input."""

import re
from collections import Counter

import pytest

pytest.importorskip("corpuswright.llm")
pipeline = pytest.importorskip("corpus_pipeline")
from test_packing import verify  # noqa: E402
from test_pii import PLAIN, valid  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes(texts):
    """Smallest id of the class of each id, all pairs compared."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", None, 0), (9002, "12 34 !!", None, "src0", 8), (9003, "", "fr", "src1", 0)], docs.schema)
    now = docs.unionByName(extra)
    seen = [now]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, now, SF).write.parquet(path)
        now = spark.read.parquet(path)
        seen.append(now)
    rows = [{r.doc_id: r for r in df.collect()} for df in seen[:-1]]
    assert all(df.columns == docs.columns for df in seen[:-1])

    raw, known, single, safe, _ = rows
    assert not {9001, 9002, 9003} & set(known)
    assert set(raw) - set(known) <= {9001, 9002, 9003}  # all other documents are of known languages

    root = classes({i: r.text for i, r in known.items()})
    assert set(single) == {i for i in known if root[i] == i}

    assert set(safe) == set(single)
    for i, r in safe.items():
        assert r.n_chars == len(r.text)
        found = [m.group() for k in PLAIN for m in re.finditer(PLAIN[k], single[i].text) if valid(k, m.group())]
        assert all(v not in r.text for v in found)
        if not found:
            assert r.text == single[i].text

    times = Counter(r.doc_id for r in seen[4].collect())
    size = {i: len(WORD.findall(r.text)) for i, r in safe.items()}
    total, taken = sum(size.values()), sum(size[i] * n for i, n in times.items())
    assert max(times.values()) <= 2 and abs(taken - 1.5 * total) <= 0.1 * total

    packed = seen[5].collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens * times[r.doc_id] for r in {r.doc_id: r for r in packed}.values())
    once = seen[4].dropDuplicates(["doc_id"])
    assert verify(pipeline.packed(spark, once, SF).collect(), {r.doc_id: r.text for r in once.collect()}, 2048) == 0


def test_empty_documents(spark):
    now = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for _, stage in pipeline.STAGES:
        now = stage(spark, now, SF)
        assert now.count() == 0
