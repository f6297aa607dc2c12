"""Byte-pair encoding with a segment tree over adjacent pair ranks, and decoding.

A text is cut into words by the vocabulary's rules. The symbols of a word are leaves of a segment tree; a leaf holds
the rank of the pair that its symbol forms with the next one, joined with its position, so the minimum at
the root is the leftmost merge of lowest rank. A merge changes at most three leaves, each corrected on its way to the root,
until no pair of the word can be merged: n symbols take O(n log n) steps however long a word is.

Words of less than 64 bytes are merged side by side, one tree per row of an array; longer ones have a tree each. A task
remembers the ids of words it has met, in bounded memory. Texts stay in the scan: there is no shuffle, and a text is
encoded in runs of words, so a long text needs memory for its ids and no more.

Defined results: null text is empty, an empty text has no ids; the strings of special tokens become their ids as the
vocabulary file asks; ids outside the vocabulary decode to nothing and bytes that are no UTF-8 to U+FFFD; repeated
rows are encoded each; an empty table gives no rows; other columns are kept as they are, and one named like a
result is replaced by it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import row_blocks

NONE = np.int64(1 << 62)  # a leaf whose symbol starts no merge
WIDEST = 64  # a word of fewer bytes is merged side by side with others
REMEMBERED = 400_000  # words a task remembers
RUN = 200_000  # words encoded at once
SYMBOLS = 1 << 18  # symbols merged side by side

# fixed values: how a byte-level vocabulary cuts text into words
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The character a byte-level vocabulary writes for each byte: printable ones themselves, the rest from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Merges:
    """Ranks of pairs of ids in a table with open addressing, and the id that each rank makes."""

    BITS = 19

    def __init__(self, pairs: list[tuple[int, int, int]]):
        left, right, self.made = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        keys = left << 32 | right
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self.keys, self.ranks = np.full(1 << self.BITS, -1, np.int64), np.full(1 << self.BITS, -1, np.int64)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            # the first of those that want a free slot gets it, the others try the next one
            free = np.flatnonzero(self.keys[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            won = todo[free[first]]
            self.keys[taken], self.ranks[taken] = keys[won], won
            rest = np.setdiff1d(np.arange(len(todo)), free[first])
            todo, slot = todo[rest], slot[rest] + 1 & (1 << self.BITS) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ keys >> 25) * 0x9E3779B97F4A7C1 >> 20) & (1 << self.BITS) - 1

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 where they do not merge."""
        keys = (left << 32 | right).ravel()
        ranks, todo, slot = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._slot(keys)
        while len(todo):
            held = self.keys[slot]
            hit = held == keys[todo]
            ranks[todo[hit]] = self.ranks[slot[hit]]
            on = ~hit & (held >= 0)
            todo, slot = todo[on], slot[on] + 1 & (1 << self.BITS) - 1
        return ranks.reshape(left.shape)


class Vocabulary:
    """Tables of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str | None):
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, cut = told["model"], told["pre_tokenizer"] or {}
        plain = not told["normalizer"] and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex") or (told["decoder"] or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        of_letter = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        ids = model["vocab"]
        self.special = {}
        for token in told["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"{path}: special tokens that take blanks along are not supported")
            self.special[token["content"]] = token["id"]
        size = max([*ids.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, i in [*ids.items(), *self.special.items()]:
            spelled[i] = b"".join(of_letter.get(c, c.encode()) for c in token)
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.of_byte = np.array([ids[c] for c in byte_letters()], np.int64)
        pairs = (m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"])
        self.merges = Merges([(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        names = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        # texts of Latin-1 characters alone, which most are, are cut by a pattern that spells out its classes
        self.words, latin = regex.compile(WORDS), "".join(map(chr, range(256)))
        signs = {c: "".join(map(re.escape, regex.findall(c, latin))) for c in (r"\s", r"\p{L}", r"\p{N}")}
        spelled_out = WORDS.replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(signs.values()) + "]").replace(r"\S", f"[^{signs[r'\s']}]")
        for name, members in signs.items():
            spelled_out = spelled_out.replace(name, f"[{members}]")
        self.latin = re.compile(spelled_out)

    def cutter(self, text: str):
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words
        return self.latin


class PairTree:
    """Segment tree over the pair ranks of one word of any length."""

    def __init__(self, symbols: list[int], rank_of: dict[int, int]):
        self.ids, self.rank_of, n = symbols, rank_of, len(symbols)
        self.bits = max(n - 1, 1).bit_length()
        self.width = 1 << self.bits
        self.after, self.before = list(range(1, n + 1)), list(range(-1, n - 1))
        self.tree = [int(NONE)] * (2 * self.width)
        for i in range(n - 1):
            self.tree[self.width + i] = self.leaf(i)
        for i in range(self.width - 1, 0, -1):
            self.tree[i] = min(self.tree[2 * i], self.tree[2 * i + 1])

    def leaf(self, i: int) -> int:
        j = self.after[i]
        rank = self.rank_of.get(self.ids[i] << 32 | self.ids[j]) if j < len(self.ids) else None
        return int(NONE) if rank is None else rank << self.bits | i

    def put(self, i: int, value: int) -> None:
        """Point update: the way to the root ends where a minimum does not change."""
        tree, i = self.tree, self.width + i
        tree[i] = value
        while i > 1:
            i >>= 1
            least = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == least:
                return
            tree[i] = least

    def merged(self, made) -> list[int]:
        ids, after, before, end = self.ids, self.after, self.before, len(self.ids)
        while self.tree[1] < NONE:
            rank, i = self.tree[1] >> self.bits, self.tree[1] & (self.width - 1)
            j = after[i]
            ids[i], after[i] = int(made[rank]), after[j]
            if after[j] < end:
                before[after[j]] = i
            self.put(j, int(NONE))
            self.put(i, self.leaf(i))
            if before[i] >= 0:
                self.put(before[i], self.leaf(before[i]))
        out, i = [], 0
        while i < end:
            out.append(ids[i])
            i = after[i]
        return out


def merge_rows(symbols: np.ndarray, sizes: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many short words, and how many each has: row r holds ``sizes[r]`` symbols and the trees run side by side.

    A row is wider than its word, so there is a place behind the last symbol.
    """
    rows, width = symbols.shape  # width is a power of two
    bits = width.bit_length() - 1
    ids = symbols.copy()
    after = np.minimum(np.arange(1, width + 1), width - 1)[None, :].repeat(rows, 0)
    before = np.maximum(np.arange(-1, width - 1), 0)[None, :].repeat(rows, 0)
    alive = np.arange(width)[None, :] < sizes[:, None]
    tree = np.full((rows, 2 * width), NONE)
    rank = merges.rank(ids[:, :-1], ids[:, 1:])
    pair = (rank >= 0) & alive[:, 1:]
    tree[:, width : 2 * width - 1] = np.where(pair, rank << bits | np.arange(width - 1), NONE)
    for level in range(bits - 1, -1, -1):
        low = tree[:, 2 << level : 4 << level]
        tree[:, 1 << level : 2 << level] = np.minimum(low[:, ::2], low[:, 1::2])
    live = np.flatnonzero(tree[:, 1] < NONE)
    end = sizes.astype(np.int64)

    def leaf(r: np.ndarray, i: np.ndarray) -> np.ndarray:
        j = after[r, i]
        found = merges.rank(ids[r, i], ids[r, j])
        return np.where((found >= 0) & (j < end[r]) & (j > i), found << bits | i, NONE)

    while len(live):
        root = tree[live, 1]
        i = root & (width - 1)
        j = after[live, i]
        k = after[live, j]
        ids[live, i] = merges.made[root >> bits]
        alive[live, j] = False
        after[live, i] = k
        inside = k < end[live]
        before[live[inside], k[inside]] = i[inside]
        h = before[live, i]
        tree[live, width + j] = NONE
        tree[live, width + i] = leaf(live, i)
        other = np.flatnonzero(h < i)
        tree[live[other], width + h[other]] = leaf(live[other], h[other])
        for changed in (j, i, h):
            node = width + changed
            for _ in range(bits):
                node >>= 1
                tree[live, node] = np.minimum(tree[live, 2 * node], tree[live, 2 * node + 1])
        live = live[tree[live, 1] < NONE]
    return ids[alive], alive.sum(1)


def merge_words(symbols: np.ndarray, length: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of words whose symbols stand one after the other: all ids, and where each word's start and how many they are."""
    first = np.cumsum(length) - length
    sizes, starts, flat, low, at = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64), [np.zeros(0, np.int32)], 0, 0

    def found(rows: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        nonlocal at
        sizes[rows], starts[rows] = n, at + np.cumsum(n) - n
        flat.append(ids.astype(np.int32))
        at += len(ids)

    for width in (4, 8, 16, 32, WIDEST):
        rows = np.flatnonzero((length >= low) & (length < width))
        low, step = width, SYMBOLS // width
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            found(part, *merge_rows(symbols[np.minimum(first[part, None] + np.arange(width), len(symbols) - 1)], length[part], merges))
    for r in np.flatnonzero(length >= WIDEST):
        ids = np.array(PairTree(symbols[first[r] : first[r] + length[r]].tolist(), merges.rank_of).merged(merges.made))
        found(np.array([r]), ids, np.array([len(ids)]))
    return np.concatenate(flat), starts, sizes


class _Numbers(dict):
    """Numbers of words; a word not met before gets the next one and is put down as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def gathered(table: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``table`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return table[:0]
    return table[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


class Encoder:
    """Ids of whole texts; remembers the ids of at most about ``remembered`` words."""

    def __init__(self, words: Vocabulary, remembered: int = REMEMBERED):
        self.words, self.remembered = words, remembered
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.sizes, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self) -> None:
        """Ids of the words that are new, put behind those known."""
        new = [w.encode() for w in self.numbers.new]
        self.numbers.new = []
        length = np.fromiter(map(len, new), np.int64, len(new))
        ids, starts, sizes = merge_words(self.words.of_byte[np.frombuffer(b"".join(new), np.uint8)], length, self.words.merges)
        self.starts, self.sizes = np.append(self.starts, starts + len(self.ids)), np.append(self.sizes, sizes)
        self.ids = np.concatenate([self.ids, ids])

    def runs(self, text: str) -> Iterator[list[str]]:
        """Words in runs of bounded length."""
        words = self.words.cutter(text)
        if len(text) <= RUN:
            yield words.findall(text)
            return
        found = (m.group() for m in words.finditer(text))
        while run := list(islice(found, RUN)):
            yield run

    def of_runs(self, runs: list[list[str]]) -> list[np.ndarray]:
        """Ids of each run of words."""
        if not runs:
            return []
        if len(self.numbers) > self.remembered:
            self.forget()
        numbers = [np.fromiter(map(self.numbers.__getitem__, run), np.int64, len(run)) for run in runs]
        if self.numbers.new:
            self.learn()
        words = np.concatenate(numbers)
        sizes = self.sizes[words]
        ends = np.append(0, np.cumsum(sizes))[np.cumsum([len(run) for run in runs])]
        return np.split(gathered(self.ids, self.starts[words], sizes), ends[:-1])

    def parts(self, text: str) -> Iterator[list[str] | int]:
        """Runs of words, and ids of special tokens between them."""
        pieces = self.words.specials.split(text) if self.words.specials else [text]
        for i, piece in enumerate(pieces):
            if i % 2:
                yield self.words.special[piece]
            elif piece:
                yield from self.runs(piece)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; short texts share a pass over the words, long ones have several."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[list[str]] = []
        places: list[tuple[int, int]] = []
        size = 0

        def put() -> None:
            for (t, k), ids in zip(places, self.of_runs(held), strict=True):
                out[t][k] = ids
            held.clear()
            places.clear()

        for t, text in enumerate(texts):
            for part in self.parts(text or ""):
                if isinstance(part, int):
                    out[t].append(np.array([part], np.int32))
                    continue
                out[t].append(part)
                held.append(part)
                places.append((t, len(out[t]) - 1))
                size += len(part)
                if size >= RUN:
                    put()
                    size = 0
        put()
        return [np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]


def decode_ids(ids: np.ndarray, sizes: np.ndarray, words: Vocabulary) -> list[str]:
    """Texts of id sequences that stand one after the other."""
    known = (ids >= 0) & (ids < len(words.lengths))
    ids = np.where(known, ids, 0).astype(np.int64)
    lengths = np.where(known, words.lengths[ids], 0)
    raw = gathered(words.spelled, words.starts[ids], lengths).tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])]
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_ENCODERS: dict[str | None, Encoder] = {}


def _encoder(vocabulary: str | None) -> Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(Vocabulary(vocabulary))
    return _ENCODERS[vocabulary]


def _replaced(batch: pa.RecordBatch, names: list[str], column: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in names if c != column], values], names=[*[c for c in names if c != column], column])


def encode(docs: DataFrame, *, text: str = "text", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with the array column ``ids`` instead of ``text``; ``vocabulary`` is a path on the executors."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    rows = docs.select(*[c for c in docs.columns if c not in (text, ids)], F.col(text).alias(ids))
    names = rows.columns
    schema = StructType([*rows.schema.fields[:-1], StructField(ids, ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(len(names) - 1)), 0).to_numpy(zero_copy_only=False)
            for a, b in row_blocks(lengths + 8, 4 << 20):
                part = batch.slice(a, b - a)
                found = encoder.encode(part.column(len(names) - 1).to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                values = pa.ListArray.from_arrays(ends, np.concatenate(found) if found else np.zeros(0, np.int32))
                yield _replaced(part, names, ids, values)

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, *, ids: str = "ids", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``encoded`` with the string column ``text`` beside ``ids``; null ids give the empty text."""
    from pyspark.sql.types import StringType, StructField, StructType

    rows = encoded.select(*[c for c in encoded.columns if c not in (text, ids)], F.col(ids).cast("array<int>").alias(ids))
    names = rows.columns
    schema = StructType([*rows.schema.fields, StructField(text, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _encoder(vocabulary).words
        for batch in batches:
            column = batch.column(len(names) - 1)
            sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            for a, b in row_blocks(sizes + 8, 1 << 20):
                part = batch.slice(a, b - a)
                flat = pa.compute.fill_null(pa.compute.list_flatten(part.column(len(names) - 1)), -1).to_numpy(zero_copy_only=False)
                found = decode_ids(flat, sizes[a:b], words)
                yield _replaced(part, names, text, pa.array(found, pa.string()))

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 for each document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    done = decode(encode(rows, vocabulary=vocabulary), vocabulary=vocabulary)
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
