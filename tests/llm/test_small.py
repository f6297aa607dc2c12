"""Mixing, quality, toxicity and language on small tables: odd rows, ties, brute force, held-out accuracy."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

pytest.importorskip("corpuswright.llm")
from corpuswright.llm import language as L  # noqa: E402
from corpuswright.llm import mixing, quality  # noqa: E402
from corpuswright.llm import queries as Q  # noqa: E402
from corpuswright.llm import toxicity as X  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
NATIVE = ["op2_hash_threshold_mix", "op4_distribution_divergence"]


@pytest.mark.parametrize("name", [*NATIVE, "op7_warc_boundary_chain"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = Q.QUERIES[name](spark, SF)
    if name in NATIVE:
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())
    cols = sorted(df.columns)
    got = sorted(str([r[c] for c in cols]) for r in df.collect())
    cur = con.execute(Q.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert got == sorted(str([r[names.index(c)] for c in cols]) for r in cur.fetchall())


# ---- mixing ----


def mixed(spark, rows, **options):
    return mixing.mix_plan(spark.createDataFrame(rows, DOCS), **options).collect()


def test_mix_targets_and_nesting(spark):
    rows = [(i, "w " * (1 + i % 9), "en", s, 0) for s, n in (("a", 40), ("b", 400), (None, 200), ("é", 4)) for i in range(n)]
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    got = mixed(spark, rows)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size) and r.source_size == sizes[r.source]
    assert math.isclose(sum(target.values()), 1.5 * sum(sizes.values()), rel_tol=1e-9)
    # the sources that are not full share by their weights: 3, 1, 2, 3 in order, null last
    weights = dict(zip(["a", "b", "é", None], [3, 1, 2, 3], strict=True))
    open_ones = {s for s in sizes if target[s] < 2 * sizes[s] - 1e-9}
    assert len({round(target[s] / weights[s], 6) for s in open_ones}) == 1 and target["a"] == 2 * sizes["a"]
    assert all(abs(taken[s] - target[s]) <= 9 for s in sizes)
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in mixed(spark, rows[::-1])}
    less = {r.doc_id: r.taken for r in mixed(spark, rows, share=1.2)}
    assert all(less[r.doc_id] <= r.taken for r in got if r.source not in ("a",))


def test_mix_odd_rows(spark):
    assert mixed(spark, []) == []
    got = mixed(spark, [(None, None, None, None, None), (1, "", "en", "s", 0), (2, " \t\n", "en", "s", 0)])
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 3
    same = mixed(spark, [(1, "a b", "en", "s", 0)] * 3 + [(2, "c d e", None, "t", 0)])
    assert len({r.taken for r in same if r.doc_id == 1}) == 1
    docs = spark.createDataFrame([(i, "x y", "en", "s", 0) for i in range(100)], DOCS)
    again = Counter(r.doc_id for r in mixing.mix_documents(docs.withColumnRenamed("n_chars", "_src")).collect())
    assert sum(again.values()) == 150 and set(again.values()) <= {1, 2}


# ---- quality ----


def counts_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    again = {j for places in windows.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again)


def test_quality_counts_against_plain_python(spark):
    rng = np.random.default_rng(3)
    texts = [None, "", " \n\t ", "one", "a b", "a b c", "a b c a b c a b", "x\ny\nx\n\n \nx", "é☃ #*$%&|<> \x0b z", "w " * 20000]
    texts += [" ".join(rng.choice(["a", "b", "c", "dd", "é,"], n)) for n in (3, 10, 49, 50, 51, 200, 3000)]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None, None, 0) for i, t in enumerate(texts)], DOCS)
    for r in quality.score_quality(docs, quality.references(docs)).collect():
        want = counts_of(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    empty = docs.where("doc_id < 0")
    assert quality.score_quality(empty, quality.references(empty)).count() == 0


def test_quality_finds_labelled_junk(spark):
    docs, labels = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet"), spark.read.parquet(f"{SF}/../sf0.01/labels.parquet")
    found = quality.score_quality(docs, quality.references(docs)).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in found if r.quality == 1], [r.kept for r in found if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.2


# ---- toxicity ----


def all_maximal(scores):
    """Ruzzo and Tompa's segments by their recursive definition."""
    if not len(scores):
        return []
    best, span = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-12:
                best, span = total, (i, j + 1)
    if span is None:
        return []
    a, b = span
    return all_maximal(scores[:a]) + [(a, b, best)] + [(s + b, e + b, v) for s, e, v in all_maximal(scores[b:])]


def test_segments_against_the_definition():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 25))
        weights = [(i, float(w)) for i, w in enumerate(rng.normal(0, 1.5, n)) if rng.random() < 0.5]
        scores = np.full(n, -X.DRIFT)
        for i, w in weights:
            scores[i] = w - X.DRIFT
        got, want = X.scoring_runs(weights), all_maximal(list(scores))
        assert [(s, e) for s, e, _ in got] == [(s, e) for s, e, _ in want]
        assert np.allclose([v for *_, v in got], [v for *_, v in want])


def test_toxicity_on_held_out_labels(spark):
    sf = f"{SF}/../sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = X.detect(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).where("held_out").join(labels, "doc_id").collect()
    told = Counter((r.toxic, r.predicted) for r in found)
    assert told[1, 1] > 0.8 * (told[1, 1] + told[1, 0]) and told[0, 1] < 0.03 * (told[0, 0] + told[0, 1])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, 0), (2, "", None, None, 0), (2, "", None, None, 0), (None, "x", None, None, 0)], DOCS)
    labels = spark.createDataFrame([(1, 1, None), (1, 1, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    got = X.detect(docs, labels).collect()
    assert len(got) == 4 and all(r.score < 0.5 and r.predicted == 0 and r.n_passages == 0 for r in got)
    assert X.detect(docs.where("doc_id = 99"), labels.where("doc_id = 99")).count() == 0


# ---- language ----


def slow_viterbi(scores, penalty):
    n, k = scores.shape
    value, back = scores[0].astype(float).copy(), []
    for t in range(1, n):
        new, b = np.empty(k), []
        for j in range(k):
            best = max(range(k), key=lambda i: (value[i] - (penalty if i != j else 0), i == j))
            b.append(best)
            new[j] = value[best] - (penalty if best != j else 0) + scores[t, j]
        back.append(b)
        value = new
    return value.max(), value, back


def test_viterbi_reaches_the_best_value():
    rng = np.random.default_rng(7)
    matrix = rng.normal(0, 3, (40, 4)).astype(np.float32)
    rows = [rng.integers(0, 40, n).astype(np.int32) for n in (0, 1, 2, 17, 60, 700)]
    for row, path in zip(rows, L.viterbi(rows, matrix, 2.5), strict=True):
        assert len(path) == len(row)
        if len(row):
            s = matrix[row]
            own = s[np.arange(len(row)), path].sum() - 2.5 * (np.diff(path) != 0).sum()
            assert math.isclose(own, slow_viterbi(s, 2.5)[0], rel_tol=1e-4, abs_tol=1e-3)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet")
    found = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.98


def test_language_spans_scripts_and_odd_rows(spark):
    train = [(i, t, lang, None, 0) for i, (t, lang) in enumerate([("the house and the garden with that", "en"), ("das haus und der garten mit dem", "de"), ("это дом и большой сад вместе с ним", "ru")] * 30)]
    model = L.fit(spark.createDataFrame(train, DOCS), where=L.F.lit(True))
    mixed = "the house with the garden and that house " * 3 + "и большой дом вместе с садом " * 3
    texts = ["", None, "12 !!", mixed, "ελληνικά λόγια εδώ", "der garten und das haus"]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in L.label_languages(docs, model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and got[0].score == 0
    assert [(s.lang, s.words) for s in got[3].spans] == [("en", 24), ("ru", 18)]
    assert got[4].lang_pred in ("en", "de", "ru") and got[4].score == 0  # a script no language uses
    assert got[5].lang_pred == "de" and got[5].score == 1
    nothing = L.fit(docs.withColumn("lang", L.F.lit(None).cast("string")), where=L.F.lit(True))
    assert {r.lang_pred for r in L.label_languages(docs, nothing).collect()} == {"und"}
    assert L.label_languages(docs.where("doc_id > 99"), model).count() == 0


def test_language_stage_keeps_mixed_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs, where=~L.held_out())
    by_lang = {r.lang: r.text.split() for r in docs.where("lang is not null and length(text) > 2000").orderBy("doc_id").collect()}
    a, b, c = list(by_lang.values())[:3]
    texts = [" ".join(a[:40] + b[:30] + c[:30]), "qqxz zzqx " * 30, "漢字 " * 30, "12 ½ ² ①", "12 ½ " + " ".join(a[:5]), " ".join(a[:200_000 // 7]) * 20]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in L.keep_known_languages(rows, model).collect()) == [0, 4, 5]
    assert {r.doc_id: r.lang_pred for r in L.label_languages(rows, model).collect()}[3] == "und"


def test_language_stage_judges_words_by_their_span(spark):
    rows = [(i, f"abcd bcda cdab dabc abcd{'abcd'[i % 4]}", "x") for i in range(40)] + [(100 + i, f"mnop nopm opmn pmno mnop{'mnop'[i % 4]}", "y") for i in range(40)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), where=~L.held_out())
    docs = spark.createDataFrame(
        [
            (0, "abcd bcda cdab dabc mnop nopm opmn pmno", None),  # two languages, a span each
            (1, "abcmnop dabopmn bcdnopm cdapmno", None),  # trigrams of both, words of none
            (2, "abcd bcda", None),
            (3, "zzzz zzzy", None),
        ],
        "doc_id long, text string, lang string",
    )
    assert sorted(r.doc_id for r in L.keep_known_languages(docs, model).collect()) == [0, 2]
