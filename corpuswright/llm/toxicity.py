"""Toxic passages as maximum-scoring segments of word log-odds.

Words and their beginnings (so that inflected forms share what is learned) get a log-odds ratio between toxic and
other labelled documents with an informative Dirichlet prior (the corpus frequencies); a word takes its own ratio
or else that of its longest beginning, if large and significant, and every word pays a small drift, so
ordinary text scores below zero. One linear scan finds all maximal scoring segments of a text. Maxima of
ordinary documents follow an extreme-value law in the text's length; it turns a segment's score into an
expected count by chance, the passages below ``max_chance`` are significant, and the best passage of a
document, so normalised, becomes a probability by logistic calibration on the labelled sample.

Defined results: null and empty texts have no passage and get the score of such texts (below 0.5); labels
of one document are joined by their maximum, null labels are ignored; without labels of both classes every
score is 0; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from corpuswright.llm.common import fold
from corpuswright.session import cut_lineage, release

LETTERS = re.compile(r"[^\W\d_]+")
DRIFT = 0.25
PREFIXES = (3, 8)  # lengths of the word beginnings that are features beside the word


class Model:
    """Word scores, the extreme-value law (lam, k) and the calibration (a + b * normalised score)."""

    def __init__(self, weights: dict[str, float], lam: float = 1.0, k: float = 1.0, a: float = -20.0, b: float = 0.0):
        self.weights, self.lam, self.k, self.a, self.b = weights, lam, k, a, b

    def normalised(self, score: float, n_words: int) -> float:
        """Minus the log of how many such segments chance gives in a text of this length; 0 without a segment."""
        return max(0.0, self.lam * score - math.log(self.k * max(n_words, 1))) if score > 0 else 0.0

    def probability(self, normalised: float) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.a + self.b * normalised))))


def scoring_runs(hits: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score), given positions with a score other than the drift.

    Every other word costs ``DRIFT``. A stack of disjoint candidates with their running sums before and after
    is merged from the right, so the work is linear in the number of scored words.
    """
    stack: list[list[float]] = []  # start, end, sum before, sum after, index of the last one with a smaller sum before
    total, at = 0.0, 0
    for place, weight in hits:
        total -= DRIFT * (place - at)
        at = place + 1
        value = weight - DRIFT
        if value <= 0:
            total += value
            continue
        item = [place, place + 1, total, total + value, -1]
        total += value
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= item[2]:
                j = int(stack[j][4])
            item[4] = j
            if j < 0 or stack[j][3] >= item[3]:
                stack.append(item)
                break
            item[0], item[2] = stack[j][0], stack[j][2]
            del stack[j:]
    return [(int(s), int(e), after - before) for s, e, before, after, _ in stack]


class _Weights(dict):
    """Raw token to weight (None: only the drift), filled on demand and bounded."""

    def __init__(self, model: Model, limit: int = 400_000):
        super().__init__()
        self.model, self.limit = model, limit

    def __missing__(self, token: str):
        if len(self) > self.limit:
            self.clear()
        get, best = self.model.weights.get, None
        for word in LETTERS.findall(token.lower()):
            for x in (word, *(word[:i] for i in range(min(PREFIXES[1], len(word) - 1), PREFIXES[0] - 1, -1))):
                if w := get(x):
                    best = max(w, best or 0.0)
                    break
        self[token] = best
        return best


def passages(text: str | None, weights: _Weights) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of words of the whole text and its maximal scoring segments."""
    words = text.split() if text else []
    hits = [(i, w) for i, w in enumerate(map(weights.__getitem__, words)) if w is not None]
    return len(words), scoring_runs(hits) if hits else []


def word_weights(sample: DataFrame, *, prior_words: float = 2000.0, min_odds: float = 3.0, min_z: float = 5.5, min_texts: int = 3, max_terms: int = 20_000) -> dict[str, float]:
    """Log-odds of words and word beginnings that mark the toxic class of a sample (text, toxic).

    A feature counts once per different text, so neither repeats nor copies make it significant. Its prior is
    its share of all counts times ``prior_words``. Kept are those with a ratio of ``min_odds`` and a difference of
    ``min_z`` standard errors between the classes' shares of texts; the driver gets ``max_terms`` rows at most.
    """
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    features = lambda w: F.array_append(F.transform(F.sequence(F.lit(PREFIXES[0]), F.lit(PREFIXES[1])), lambda i: F.substring(w, F.lit(1), i)), w)
    texts = sample.groupBy("text").agg(F.max("toxic").alias("toxic"))
    words = texts.select("toxic", F.explode(F.array_distinct(F.flatten(F.transform(found, features)))).alias("word"))
    counts = cut_lineage(words.groupBy("word").agg(F.sum("toxic").alias("y1"), F.sum(1 - F.col("toxic")).alias("y0")))
    total = counts.agg(F.sum("y1").alias("n1"), F.sum("y0").alias("n0")).first()
    docs = texts.agg(F.sum("toxic").alias("t1"), F.sum(1 - F.col("toxic")).alias("t0")).first()
    if not total["n1"] or not total["n0"]:
        release(counts)
        return {}
    n1, n0, t1, t0 = (float(x) for x in (*total, *docs))
    y1, y0 = F.col("y1"), F.col("y0")
    prior = (y1 + y0) * F.lit(prior_words / (n1 + n0))
    odds = lambda y, n: F.log(y + prior) - F.log(F.lit(n + prior_words) - y - prior)
    pooled = (y1 + y0) / (t1 + t0)
    z = (y1 / t1 - y0 / t0) / F.sqrt(pooled * (1 - pooled) * (1 / t1 + 1 / t0))
    rows = counts.select("word", (odds(y1, n1) - odds(y0, n0)).alias("delta"), z.alias("z"), (y1 + y0).alias("n"))
    rows = rows.where((F.col("z") >= min_z) & (F.col("delta") >= min_odds) & (F.col("n") >= min_texts))
    out = {r["word"]: float(r["delta"]) for r in rows.orderBy(F.desc("z"), "word").limit(max_terms).collect()}
    release(counts)
    return out


def extreme_value_law(maxima: list[tuple[float, int]]) -> tuple[float, float]:
    """lam and k from the best scores and lengths of ordinary documents, by the method of moments.

    A text without a segment counts with score 0; lengths enter through the mean of their logarithms.
    """
    if len(maxima) < 2:
        return 1.0, 1.0
    s = np.array([m for m, _ in maxima])
    logs = np.log([max(n, 1) for _, n in maxima])
    lam = math.pi / (math.sqrt(6) * max(float(s.std()), 0.25))
    return lam, float(np.exp(lam * s.mean() - np.euler_gamma - logs.mean()))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of y on x with a little ridge, by Newton's method."""
    w, design = np.zeros(2), np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -60, 60)))
        grad = design.T @ (weight * (p - y)) + 1e-3 * w
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0))


def _best(docs: DataFrame, model: Model, schema: str, columns: list[str], rows_of) -> DataFrame:
    spark_schema = _parse_datatype_string(schema)
    arrow_schema = to_arrow_schema(spark_schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(shared.value)
        for batch in batches:
            out: list[list] = [[] for _ in arrow_schema]
            own = batch.column(0).to_pylist()
            for key, text in zip(own, batch.column(1), strict=True):
                n, found = passages(text.as_py(), weights)
                for column, v in zip(out, rows_of(shared.value, key, n, found), strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow_schema, strict=True)], schema=arrow_schema)

    return docs.select(*columns).mapInArrow(run, spark_schema)


def fit(docs: DataFrame, labels: DataFrame, *, where, docs_per_class: int = 5000) -> Model:
    """Learn from documents (doc_id, text) whose labels (doc_id, toxic) satisfy ``where``.

    About ``docs_per_class`` documents of each class are used at most, chosen by a hash of the id; weights
    restore the classes' shares in the calibration.
    """
    marks = labels.where(where & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return Model({})
    share = {y: min(1.0, docs_per_class / n) for y, n in sizes.items()}
    spot = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    marks = cut_lineage(marks.where(spot < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])))
    sample = cut_lineage(docs.select("doc_id", "text").join(marks, "doc_id").select("text", F.col("toxic").cast("long").alias("toxic")))
    weights = word_weights(sample)
    model = Model(weights)
    best = _best(sample, model, "toxic long, top double, n long", ["toxic", "text"], lambda _m, key, n, found: (key, max((f[2] for f in found), default=0.0), n))
    seen = [(r["toxic"], r["top"], r["n"]) for r in best.collect()]  # bounded by docs_per_class
    release(marks, sample)
    model.lam, model.k = extreme_value_law([(s, n) for y, s, n in seen if not y])
    x = np.array([model.normalised(s, n) for _, s, n in seen])
    model.a, model.b = calibrate(x, np.array([float(y) for y, _, _ in seen]), np.array([1 / share[y] for y, _, _ in seen]))
    return model


SCHEMA = "doc_id {kind}, score double, predicted int, n_words long, passages array<struct<first:int,words:int,score:double,chance:double>>"


def score_documents(docs: DataFrame, model: Model, *, max_chance: float = 0.01) -> DataFrame:
    """Score, prediction and significant passages of every whole text. Equal texts get equal results."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def row(m: Model, key, n: int, found):
        tops = [(s, e, v, m.normalised(v, n)) for s, e, v in found]
        p = m.probability(max((t[3] for t in tops), default=0.0))
        kept = [{"first": s, "words": e - s, "score": v, "chance": math.exp(-x)} for s, e, v, x in tops if math.exp(-x) <= max_chance]
        return key, p, int(p >= 0.5), n, kept

    return _best(docs, model, SCHEMA.format(kind=kind), ["doc_id", "text"], row)


def held_out(doc_id: str = "doc_id"):
    return fold(doc_id, 5) == 0


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels outside the held-out fifth, then score all documents."""
    scored = score_documents(docs, fit(docs, labels, where=~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_words", F.size("passages").cast("long").alias("n_passages"))
