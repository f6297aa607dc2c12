"""Language spans of mixed text: script ranges, per-word scores, Viterbi with a switching penalty.

Training counts letter trigrams per language on a bounded sample of labelled documents. A word's score for a
language is the sum of its trigrams' log probabilities, as a share of all candidate languages. Which languages
are candidates follows from the word's script: those that use it in training. Viterbi then labels
the words of a whole text, paying a penalty for each change of language, and runs of one label are its spans.

Defined results: null text, or text without a letter, is ``und`` with score 0 and no spans; words of a script no language
uses count for none; ties go to the first language by name; without training rows everything
is ``und``; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import fold, row_blocks
from corpuswright.session import cut_lineage

# fixed values: first and last code points of script blocks
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("latin", 0x1E00, 0x1EFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]

LETTERS = regex.compile(r"\p{L}+")
UND = "und"


def script_of(letter: str) -> str:
    code = ord(letter)
    return next((name for name, first, last in SCRIPTS if first <= code <= last), "other")


class Model:
    """Log probabilities (trigram x language) and the languages that use each script."""

    def __init__(self, languages: list[str], grams: dict[str, int], logp: np.ndarray, scripts: dict[str, np.ndarray], penalty: float, floor: float):
        self.languages, self.grams, self.logp, self.scripts, self.penalty, self.floor = languages, grams, logp, scripts, penalty, floor
        self._script: dict[str, np.ndarray | None] = {}
        # trigrams that a language has; the last row stands for all that were not learned
        self.seen = logp > logp[-1] + 1e-3

    def scores(self, tokens: list[str]) -> np.ndarray:
        """tokens x (2 languages + 2): log shares, at least ``floor``.

        Two columns are 1 if the token has a candidate language, and a letter; the last ones if most of its trigrams
        were learned from the language.
        """
        k = len(self.languages)
        out = np.zeros((len(tokens), 2 * k + 2), np.float32)
        rows, ids, starts, barred = [], [], [], []
        unseen, get, script = len(self.logp) - 1, self.grams.get, self._script
        for i, token in enumerate(tokens):
            found = LETTERS.findall(token.lower())
            if not found:
                continue
            out[i, k + 1] = 1
            letter = found[0][0]
            if letter not in script:
                mask = self.scripts.get(script_of(letter))
                script[letter] = None if mask is None else np.where(mask, 0, -1e6)
            if script[letter] is None:
                continue
            rows.append(i)
            barred.append(script[letter])
            starts.append(len(ids))
            for word in found:
                word = f"^{word}$"
                ids += [get(word[j : j + 3], unseen) for j in range(len(word) - 2)]
        if rows:
            out[rows, k] = 1
            s = np.add.reduceat(self.logp[ids], starts, axis=0) + np.array(barred)
            learned = np.add.reduceat(self.seen[ids].astype(np.int32), starts, axis=0)
            out[rows, k + 2 :] = (2 * learned > np.diff([*starts, len(ids)])[:, None]) & (np.array(barred) == 0)
            s -= s.max(axis=1, keepdims=True)
            s -= np.log(np.exp(s).sum(axis=1, keepdims=True))
            out[rows, :k] = np.maximum(s, self.floor)
        return out


class _Cache(dict):
    """Token to row of a growing score matrix; kept by a Python worker while the model stays the same."""

    def __init__(self, model: Model, limit: int = 200_000):
        super().__init__()
        self.model, self.limit, self.parts, self.n = model, limit, [], 0

    def rows(self, words: list[str]) -> np.ndarray:
        new = [w for w in set(words) if w not in self]
        if new:
            self.parts.append(self.model.scores(new))
            self.update(zip(new, range(self.n, self.n + len(new)), strict=True))
            self.n += len(new)
        return np.fromiter((self[w] for w in words), np.int32, len(words))

    def matrix(self) -> np.ndarray:
        if len(self.parts) > 1:
            self.parts = [np.concatenate(self.parts)]
        return self.parts[0] if self.parts else np.zeros((0, 2 * len(self.model.languages) + 2), np.float32)

    def trim(self) -> None:
        if self.n > self.limit:
            self.clear()
            self.parts, self.n = [], 0


def viterbi(rows: list[np.ndarray], scores: np.ndarray, penalty: float) -> list[np.ndarray]:
    """Best labels of each document, whose words are rows of ``scores`` (words x languages).

    All documents advance together, longest first, so a step costs one small matrix operation.
    """
    order = sorted(range(len(rows)), key=lambda d: -len(rows[d]))
    lengths = np.array([len(rows[d]) for d in order])
    longest = int(lengths[0]) if len(order) else 0
    if not longest:
        return [np.zeros(0, np.int8) for _ in rows]
    k, starts = scores.shape[1], np.concatenate([[0], np.cumsum(lengths)[:-1]])
    flat = np.concatenate([rows[d] for d in order])
    active = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
    back = np.empty((len(flat), k), np.int16)
    value = scores[flat[starts[: active[0]]]].astype(np.float64)
    stay = np.arange(k)
    for t in range(1, longest):
        n = active[t]
        at = starts[:n] + t
        before = value[:n]
        top = before.argmax(axis=1)
        switch = before[np.arange(n), top][:, None] - penalty
        kept = before >= switch
        back[at] = np.where(kept, stay, top[:, None])
        value[:n] = np.where(kept, before, switch) + scores[flat[at]]
        if t % 512 == 0:
            value[:n] -= value[:n].max(axis=1, keepdims=True)
    labels = np.empty(len(flat), np.int16)
    state = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = state[:n]
        if t:
            state[:n] = back[at, state[:n]]
    out: list = [None] * len(rows)
    for place, d in enumerate(order):
        out[d] = labels[starts[place] : starts[place] + lengths[place]]
    return out


def training_sample(docs: DataFrame, *, lang: str, where, docs_per_language: int, by: str) -> DataFrame:
    """About ``docs_per_language`` rows of each language, chosen by a hash of ``by``."""
    rows = docs.where(where & F.col(lang).isNotNull() & F.col("text").isNotNull())
    sizes = cut_lineage(rows.groupBy(lang).agg(F.count(F.lit(1)).alias("_n")))  # its written size lets Spark broadcast it
    share = F.lit(float(docs_per_language)) / F.col("_n")
    spot = F.pmod(F.xxhash64(F.col(by), F.lit(17)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.join(sizes, lang).where(spot < share).drop("_n")


def fit(docs: DataFrame, *, where, docs_per_language: int = 3000, max_grams: int = 60_000, penalty: float = 6.0, floor: float = -8.0) -> Model:
    """Learn from rows (doc_id, text, lang) for which ``where`` holds.

    The counts are Spark aggregates of a sample bounded by ``docs_per_language``; of the trigrams the
    ``max_grams`` most frequent are kept, which bounds the model that is sent to the tasks.
    """
    sample = training_sample(docs.select("doc_id", "text", "lang"), lang="lang", where=where, docs_per_language=docs_per_language, by="doc_id")
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    words = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    padded = F.concat(F.lit("^"), "word", F.lit("$"))
    grams = words.select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substring(padded, i, F.lit(3)))).alias("gram"))
    per_language = grams.groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    top = per_language.groupBy("gram").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")).orderBy(F.desc("all"), "gram").limit(max_grams)
    letters = words.groupBy("lang", F.substring("word", 1, 1).alias("letter")).agg(F.sum("n").alias("n"))
    found, used = top.collect(), letters.collect()
    languages = sorted({r["lang"] for r in used})
    place = {x: i for i, x in enumerate(languages)}
    counts = np.full((len(found) + 1, len(languages)), 0.5)
    for i, r in enumerate(found):
        for x, n in r["by"].items():
            counts[i, place[x]] += n
    logp = np.log(counts / counts.sum(axis=0)) if languages else np.zeros((1, 0))
    scripts: dict[str, np.ndarray] = {}
    total = np.zeros(len(languages))
    for r in used:
        scripts.setdefault(script_of(r["letter"]), np.zeros(len(languages)))[place[r["lang"]]] += r["n"]
        total[place[r["lang"]]] += r["n"]
    masks = {name: n >= 0.01 * total for name, n in scripts.items()}
    return Model(languages, {r["gram"]: i for i, r in enumerate(found)}, logp.astype(np.float32), {s: m for s, m in masks.items() if m.any()}, penalty, floor)


_CACHE: dict[int, _Cache] = {}

SCHEMA = "doc_id {kind}, lang_pred string, score double, n_words long, spans array<struct<lang:string,first:int,words:int>>"


def label_batch(ids: list, texts: list, model: Model, cache: _Cache) -> dict[str, list]:
    """Columns of ``SCHEMA`` for a batch of whole texts."""
    cache.trim()
    rows = [cache.rows(t.split()) if t else np.zeros(0, np.int32) for t in texts]
    matrix, k = cache.matrix(), len(model.languages)
    paths = viterbi(rows, matrix[:, :k], model.penalty) if k else rows
    out: dict[str, list] = {"doc_id": ids, "lang_pred": [], "score": [], "n_words": [], "spans": []}
    for text, row, path in zip(texts, rows, paths, strict=True):
        if not text or not k or not LETTERS.search(text):
            for name, v in (("lang_pred", UND), ("score", 0.0), ("n_words", len(row)), ("spans", [])):
                out[name].append(v)
            continue
        known = matrix[row, k] > 0
        n = np.bincount(path[known], minlength=k)
        best = int(n.argmax())
        edges = np.flatnonzero(np.diff(path)) + 1
        starts = np.concatenate([[0], edges])
        ends = np.concatenate([edges, [len(path)]])
        out["lang_pred"].append(model.languages[best])
        out["score"].append(float(n[best] / n.sum()) if n.any() else 0.0)
        out["n_words"].append(len(row))
        out["spans"].append([{"lang": model.languages[path[a]], "first": int(a), "words": int(b - a)} for a, b in zip(starts, ends, strict=True)])
    return out


def label_languages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (share of its words in spans of that language), n_words and spans of every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = shared.id if hasattr(shared, "id") else id(shared)
        cache = _CACHE.get(key)
        if cache is None:
            _CACHE.clear()
            cache = _CACHE[key] = _Cache(shared.value)
        for batch in batches:
            for a, b in _by_text(batch, 1):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_pydict(label_batch(part.column(0).to_pylist(), part.column(1).to_pylist(), shared.value, cache), schema=out_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    spark_schema = _parse_datatype_string(SCHEMA.format(kind=kind))
    out_schema = to_arrow_schema(spark_schema)
    return docs.select("doc_id", F.col("text")).mapInArrow(run, spark_schema)


def held_out(doc_id: str = "doc_id"):
    return fold(doc_id, 3) == 1


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents outside the held-out third, then label all."""
    labelled = label_languages(docs, fit(docs, where=~held_out()))
    return labelled.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_words", F.size("spans").cast("long").alias("n_spans"))


def known_words(texts: list, cache: _Cache) -> list[float]:
    """Share of each text's words with letters that look like the language of their span; 0 without such words.

    The spans are those of ``label_batch``: Viterbi over the words' scores.
    """
    cache.trim()
    rows = [cache.rows(t.split()) if t else np.zeros(0, np.int32) for t in texts]
    matrix, k = cache.matrix(), len(cache.model.languages)
    letters = [matrix[r, k + 1].sum() for r in rows]
    paths = viterbi(rows, matrix[:, :k], cache.model.penalty)
    return [float(matrix[r, k + 2 + path].sum() / n) if n else 0.0 for r, path, n in zip(rows, paths, letters, strict=True)]


def keep_known_languages(docs: DataFrame, model: Model, *, min_known: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose text has no letter or less than ``min_known`` of its words in learned languages.

    Viterbi gives every word the language of its span, so the text may mix languages; a word is known if that language
    uses its script and most of its trigrams were seen there in training. Rows pass through whole, so nothing is joined or shuffled. Without learned languages only
    letters are asked for.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Cache(shared.value)
        for batch in batches:
            for a, b in _by_text(batch, at):
                part = batch.slice(a, b - a)
                texts = part.column(at).to_pylist()
                if shared.value.languages:
                    keep = [share >= min_known for share in known_words(texts, cache)]
                else:
                    keep = [bool(t and LETTERS.search(t)) for t in texts]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _by_text(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int]]:
    """Slices of rows with up to about two million characters of text."""
    return row_blocks(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False) + 64, 2 << 20)
