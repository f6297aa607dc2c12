"""Packing documents into training sequences by lexical retrieval.

Each text is tokenised once. Full windows of a long document are sequences of their own; what remains, its tail, is
packed with lexical neighbours. Tails are dealt to shards of bounded size by their rarest token, so related
tails meet, and a shard holds a BM25 inverted index over its tails with the document frequencies of the whole
corpus. A seed's heaviest tokens query the index, unused neighbours fill its window in order of score, the last one is
cut where the window ends, and its rest becomes the next seed. So windows have no padding; the last
window of a shard is cut into sequences whose lengths are powers of two.

Defined results: null text is empty, an empty text is its closing id alone; repeated rows are packed each; ties go to the smaller place
in the shard; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.chosen_path import _groups
from corpuswright.llm.common import arrow_rows, row_blocks
from corpuswright.session import cut_lineage

END_ID = 1
K1, B = 1.2, 0.75


# fixed values: the rules of the vocabulary files whose texts are cut here instead of by the tokenizer
LOWER_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}

# what these rules cut a plain text into: runs of letters, single digits, runs of other signs. A text with any
# other character, an apostrophe or "<|" is not plain
_LETTERS = "A-ZÀ-ÖØ-Þa-zß-öø-ÿ"
_SIGNS = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"
_BLANK, _LETTER, _DIGIT, _SIGN = range(4)
_SORTS = [re.compile(r"[ \t\n\r]"), re.compile(f"[{_LETTERS}]"), re.compile("[0-9]"), re.compile(f"[{_SIGNS}]")]
_SORT = np.array([next((k for k, sort in enumerate(_SORTS) if sort.fullmatch(chr(c))), 255) for c in range(256)], np.uint8)
_PLAIN_BYTES = bytes(np.flatnonzero(_SORT != 255).tolist())
_IN_LOWER = bytes(ord(chr(c).lower()) if _SORT[c] == _LETTER else c for c in range(256))


class _Recent(dict):
    """Memory of at most twice ``limit`` entries: what the last ``limit`` new ones and the ones before them are."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key) -> bytes:
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Token ids of whole texts, as the vocabulary file gives them.

    Where the file has the rules of ``LOWER_WORDS``, characters are never joined across blanks, so the ids of a text are
    those of its pieces between blanks one after the other; pieces met lately are remembered. Plain texts are cut into words
    here, many texts together, and each different word goes to the byte-pair model; the pieces of others go through the
    whole tokenizer. A file with other rules gets whole texts.
    """

    def __init__(self, vocabulary: str | None, limit: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if vocabulary is None:
            import public_tokenizers

            vocabulary = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        told = {k: getattr(self.tokenizer, k) for k in LOWER_WORDS}
        self.by_pieces = {k: part and json.loads(part.__getstate__()) for k, part in told.items()} == LOWER_WORDS
        if self.by_pieces:
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.as_bytes = str.maketrans({chr(c): split(chr(c))[0][0] for c in range(256) if _SORT[c] not in (_BLANK, 255) and _IN_LOWER[c] == c})
            self.words, self.pieces = _Recent(self._word, limit), _Recent(self._piece, limit // 20)

    def _word(self, word: bytes) -> bytes:
        """Ids of a lower-case word in Latin-1."""
        said = word.decode("ascii") if word.isascii() else word.decode("latin-1").translate(self.as_bytes)
        return array(self.code, [t.id for t in self.model.tokenize(said)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, self.kind).tobytes()

    def ids(self, text: str | None) -> np.ndarray:
        return self.ids_of_all([text or ""])[0]

    def ids_of_all(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_pieces:
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, self.kind) for t in texts]
        plain = [plain_bytes(t) for t in texts]
        together = iter(self._ids_of_plain([raw for raw in plain if raw is not None]))
        return [self._ids_by_piece(t) if raw is None else next(together) for t, raw in zip(texts, plain, strict=True)]

    def _ids_by_piece(self, text: str) -> np.ndarray:
        pieces = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), self.kind)

    def _ids_of_plain(self, raws: list[bytes]) -> list[np.ndarray]:
        """Ids of plain texts: all words of all texts in one array, in which equal ones are looked up once."""
        if not raws:
            return []
        raw = np.frombuffer(b"\n".join([*raws, b""]), np.uint8)
        sort = _SORT[raw]
        starts = np.concatenate([[True], sort[1:] != sort[:-1]]) | (sort == _DIGIT)
        kept = sort != _BLANK
        starts &= kept
        text_ends = np.cumsum([len(r) + 1 for r in raws])
        words_before = np.searchsorted(np.flatnonzero(starts), text_ends)
        letters = raw[kept]
        edges = np.append(np.flatnonzero(starts[kept]), len(letters)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(letters)]).dictionary_encode()
        codes = words.indices.to_numpy()
        known = list(map(self.words.__getitem__, words.dictionary.to_pylist()))
        flat = np.frombuffer(b"".join(known), self.kind)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.kind.itemsize
        first, lengths = np.cumsum(sizes) - sizes, sizes[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(ends[-1], self.kind)
        for a, b in row_blocks(lengths, 1 << 18):
            out[ends[a] : ends[b]] = flat[np.repeat(first[codes[a:b]] - ends[a:b], lengths[a:b]) + np.arange(ends[a], ends[b])]
        return np.split(out, ends[words_before[:-1]])


def plain_bytes(text: str) -> bytes | None:
    """A plain text in lower-case Latin-1; None for others."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if raw.translate(None, _PLAIN_BYTES) or b"<|" in raw else raw.translate(_IN_LOWER)


_ENCODERS: dict[str | None, Encoder] = {}


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


PIECE = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenise(docs: DataFrame, window: int, vocabulary: str | None) -> DataFrame:
    """Rows of full windows (tail null) and one row per tail (sequence_id null), from (doc_id, text)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(PIECE.format(kind=docs.schema["doc_id"].dataType.simpleString()) + ", tail binary")
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _ENCODERS:
            _ENCODERS[vocabulary] = Encoder(vocabulary)
        encoder, part, full = _ENCODERS[vocabulary], TaskContext.get().partitionId(), 0
        pa.default_memory_pool().release_unused()
        end = encoder.kind.type(END_ID)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for first, last in row_blocks(sizes + 64, 4 << 20):
                rows = batch.slice(first, last - first)
                out: list[tuple] = []
                texts = [t or "" for t in rows.column(1).to_pylist()]
                # copies of a row, as a mix makes them, follow each other
                new = [k == 0 or t != texts[k - 1] for k, t in enumerate(texts)]
                different = iter(encoder.ids_of_all([t for t, yes in zip(texts, new, strict=True) if yes]))
                for doc, yes in zip(rows.column(0).to_pylist(), new, strict=True):
                    if yes:
                        ids = np.append(next(different), end)
                    whole = len(ids) // window * window
                    for a in range(0, whole, window):
                        out.append((doc, a, window, crc_of(ids[a : a + window]), len(ids), part << 34 | full << 1, 0, None))
                        full += 1
                    if whole < len(ids):
                        out.append((doc, whole, len(ids) - whole, 0, len(ids), None, None, ids[whole:].tobytes()))
                columns = list(zip(*out, strict=True)) if out else [[] for _ in arrow_schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow_schema, strict=True)], schema=arrow_schema)

    return docs.mapInArrow(run, schema)


def _tails(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column one after the other, and the length of each tail."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), kind), np.array([len(x) // kind.itemsize for x in raw], np.int64)


def _distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs (high, low) in order, and how often each occurs. Small numbers share 32 bits, which sort faster."""
    bits, kind = (16, np.uint32) if max(int(high.max(initial=0)), int(low.max(initial=0))) < 1 << 16 else (32, np.int64)
    pairs = (high.astype(kind) << kind(bits)) | low.astype(kind)
    pairs.sort()
    edges = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    counts = np.diff(np.append(edges, len(pairs)))
    pairs = pairs[edges]
    return (pairs >> kind(bits)).astype(np.int64), (pairs & kind((1 << bits) - 1)).astype(np.int64), counts


def document_frequencies(tails: DataFrame, kind: np.dtype) -> tuple[np.ndarray, int, float]:
    """Tails that hold each token, number of tails, mean length; the driver gets a row per token of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids, lengths = _tails(batch.column(0), kind)
            _, token, _ = _distinct(np.repeat(np.arange(len(lengths)), lengths), ids)
            seen = np.bincount(token, minlength=len(total))
            seen[: len(total)] += total
            total = seen
        token = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"token": token.astype(np.int64), "n": total[token]})

    found = tails.select("tail").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    size = tails.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("s")).first()
    df = np.zeros(max((r["token"] for r in found), default=0) + 1, np.int64)
    for r in found:
        df[r["token"]] = r["n"]
    return df, size["n"], (size["s"] or 0) / max(size["n"], 1)


def shard_signs(tails: DataFrame, df, kind: np.dtype) -> DataFrame:
    """``tails`` with ``sign``: its rarest token that another tail has too (0 if none)."""
    names = tails.columns
    key = tails.sparkSession.sparkContext.broadcast(np.where(df > 1, df, np.iinfo(np.int64).max))
    from pyspark.sql.types import LongType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, lengths = _tails(batch.column(names.index("tail")), kind)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            # the rarest by frequency, then by id, as the minimum of one number
            rare = np.minimum(key.value[ids], 1 << 40) * 65_536 * 16 + ids
            sign = np.minimum.reduceat(rare, starts) & (65_536 * 16 - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sign.astype(np.int64))], names=[*names, "sign"])

    return tails.mapInArrow(run, StructType([*tails.schema.fields, StructField("sign", LongType())]))


class Index:
    """BM25 inverted index of one shard: postings (tail, weight) by token."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, df: np.ndarray, n: int, mean: float, query_terms: int):
        self.n, self.lengths = len(lengths), lengths
        token, tail, tf = _distinct(ids, np.repeat(np.arange(self.n), lengths))
        idf = np.log(1 + (n - df[token] + 0.5) / (df[token] + 0.5))
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[tail] / max(mean, 1.0)))
        self.tail, self.weight = tail, weight
        edges = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
        self.first = np.append(edges, len(token))
        number = np.repeat(np.arange(len(edges)), np.diff(self.first))
        # each tail's heaviest tokens are its query
        order = np.lexsort((-weight, tail))  # stable: ties go to the smaller token
        rank = np.arange(len(order)) - np.concatenate([[0], np.cumsum(np.bincount(tail, minlength=self.n))[:-1]])[tail[order]]
        chosen = order[rank < query_terms]
        self.query = np.split(number[chosen], np.cumsum(np.bincount(tail[chosen], minlength=self.n))[:-1]) if self.n else []

    def scores(self, tail: int) -> np.ndarray:
        spans = [slice(self.first[q], self.first[q + 1]) for q in self.query[tail]]
        if not spans:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.tail[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n)


def pack_shard(index: Index, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (tail, from, to), each filled greedily with the seed's best unused neighbours."""
    used = np.zeros(index.n, bool)
    sequences: list[list[tuple[int, int, int]]] = []
    free, seed, start, lengths = 0, -1, 0, index.lengths
    while True:
        if seed < 0:
            while free < index.n and used[free]:
                free += 1
            if free == index.n:
                return sequences
            seed, start = free, 0
            used[seed] = True
        room = window - (int(lengths[seed]) - start)
        now = [(seed, start, int(lengths[seed]))]
        score = index.scores(seed)
        score[used] = -1.0
        seed, take = -1, 16
        while room > 0:
            best = np.argpartition(-score, min(take, index.n - 1))[:take] if take < index.n else np.arange(index.n)
            best = best[np.lexsort((best, -score[best]))]
            for t in best.tolist():
                if used[t] or room <= 0:
                    continue
                used[t] = True
                score[t] = -1.0
                n = int(lengths[t])
                now.append((t, 0, min(n, room)))
                if n > room:
                    seed, start = t, room
                room -= n
            if room <= 0 or take >= index.n:
                break
            take *= 4
        sequences.append(now)


def powers_of_two(sequence: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A short sequence cut into sequences whose lengths are the binary digits of its own."""
    rest, out = list(sequence), []
    total = sum(b - a for _, a, b in rest)
    for bit in range(total.bit_length() - 1, -1, -1):
        need = total & (1 << bit)
        part: list[tuple[int, int, int]] = []
        while need:
            t, a, b = rest[0]
            n = min(need, b - a)
            part.append((t, a, a + n))
            need -= n
            rest[0] = (t, a + n, b)
            if a + n == b:
                rest.pop(0)
        if part:
            out.append(part)
    return out


def pack(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = 2048, shard_tails: int = 2000, query_terms: int = 24, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``vocabulary`` is the path of a tokenizers file on the executors. A shard has ``shard_tails`` tails on average
    and at most about twice as many: a sign that more tails share is split by row. Runs jobs while the plan is built.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    kind = _ENCODERS[vocabulary].kind
    with arrow_rows(docs.sparkSession, 1000):
        pieces = cut_lineage(tokenise(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), window, vocabulary))
    full = pieces.where("tail is null").drop("tail")
    tails = pieces.where("tail is not null").select("doc_id", "start", "length", "doc_tokens", "tail")
    df, n, mean = document_frequencies(tails, kind)
    shards = max(1, math.ceil(n / shard_tails))
    signed = shard_signs(tails, df, kind).withColumn("row", F.monotonically_increasing_id()).withColumn("bucket", F.pmod(F.xxhash64("sign"), F.lit(shards)))
    sizes = signed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * shard_tails)
    large = cut_lineage(sizes.select("bucket", F.ceil(F.col("n") / shard_tails).alias("parts")))
    spread = F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0))
    dealt = signed.join(large, "bucket", "left").withColumn("shard", (F.shiftleft("bucket", 20) + spread).cast("long"))
    dealt = dealt.select("shard", "row", "doc_id", "start", "length", "doc_tokens", "tail")
    shared = docs.sparkSession.sparkContext.broadcast((df, n, mean))
    schema = full.schema
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, mean = shared.value
        for group in _groups(batches, "shard"):
            ids, lengths = _tails(group["tail"].combine_chunks(), kind)
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            doc, start, tokens = (group[c].to_pylist() for c in ("doc_id", "start", "doc_tokens"))
            number = group["shard"][0].as_py() << 21
            packed = pack_shard(Index(ids, lengths, df, n, mean, query_terms), window)
            if packed and sum(b - a for _, a, b in packed[-1]) < window:
                packed[-1:] = powers_of_two(packed[-1])
            out: list[tuple] = []
            for k, sequence in enumerate(packed):
                offset = 0
                for t, a, b in sequence:
                    out.append((doc[t], start[t] + a, b - a, crc_of(ids[first[t] + a : first[t] + b]), tokens[t], number | k << 1 | 1, offset))
                    offset += b - a
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow_schema, strict=True)], schema=arrow_schema)

    packed = dealt.repartition("shard").sortWithinPartitions("shard", "doc_id", "row").mapInArrow(run, schema)
    return full.unionByName(packed)
