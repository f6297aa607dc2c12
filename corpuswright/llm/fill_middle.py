"""Fill-in-middle texts by secondary-sort assembly.

A map task cuts each text into pieces of whole units and gives every piece its position in the rearranged output. Pieces
are repartitioned by document and sorted by position within the partition, the DataFrame form of
``repartitionAndSortWithinPartitions``, so a task streams a document's output piece by piece into an incremental
digest and holds one piece at a time. For restoration the same task reads the sections off the output (its form and
its sentinels), gives each piece its place in the original, and a second sort inside the partition streams them
into the digest of the restored text. Text crosses the network once.

A document's key is a digest of its id and its text, so a repeated map task deals the same pieces to the same
partitions. A unit is a run of ASCII letters or any other single code point.

Defined results: null text is empty, and empty texts are plain; a null id counts as empty text in the hashes; rows that are equal in id and
text give one result row each; very long texts travel as pieces, and one run of letters is never cut; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PREFIX, MIDDLE, SUFFIX = 0, 1, 2  # sections in the order of the original text
SENTINELS = {PREFIX: b"<P>", SUFFIX: b"<S>", MIDDLE: b"<M>"}
ORDERS = {"plain": (), "psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PIECE_UNITS = 4096
LAST = 1 << 62  # place of the row that closes a document

FACTS = "n long, form string, prefix_chars long, middle_chars long"


def unit_starts(raw: np.ndarray) -> np.ndarray:
    """Byte offsets at which the units of UTF-8 bytes start."""
    letter = ((raw | 32) - np.uint8(97)) < 26
    start = (raw & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def choices(doc_id, n: int, rate: int, spm_rate: int, seed: str) -> tuple[int, int, str]:
    """Units before the middle, units before the suffix, and the form, from hashes of the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return a, b, "plain" if h[2] % 100 >= rate else "spm" if h[3] % 100 < spm_rate else "psm"


def _code_points(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def cut_text(doc_id, text: bytes, *, rate: int, spm_rate: int, seed: str, piece_units: int) -> tuple[tuple, list[bytes]]:
    """(n, form, prefix_chars, middle_chars) and the output as pieces; a section's first piece starts with its sentinel."""
    raw = np.frombuffer(text, np.uint8)
    starts = unit_starts(raw)
    n = len(starts)
    a, b, form = choices(doc_id, n, rate, spm_rate, seed)
    if not text or any(s in text for s in SENTINELS.values()):
        form = "plain"
    at = np.append(starts, len(text))

    def chunks(first: int, last: int) -> list[bytes]:
        marks = [*range(first, last, piece_units), last]
        return [text[at[x] : at[y]] for x, y in zip(marks, marks[1:], strict=False)] or [b""]

    if form == "plain":
        return (n, form, None, None), chunks(0, n)
    ends = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
    out: list[bytes] = []
    for section in ORDERS[form]:
        first, *rest = chunks(*ends[section])
        out += [SENTINELS[section] + first, *rest]
    return (n, form, _code_points(raw[: at[a]]), _code_points(raw[at[a] : at[b]])), out


class Sections:
    """Reads the sections off an output that arrives piece by piece: ``take`` gives a piece's section and its text.

    Texts of these forms hold no sentinel, so a piece that starts with the one that comes next opens that section.
    """

    def __init__(self, form: str):
        self.ahead, self.now = list(ORDERS[form]), PREFIX

    def take(self, piece: bytes) -> tuple[int, bytes]:
        if self.ahead and piece.startswith(SENTINELS[self.ahead[0]]):
            self.now = self.ahead.pop(0)
            return self.now, piece[3:]
        return self.now, piece


def restore(output: str, form: str) -> str:
    """The original of one whole output."""
    if form == "plain":
        return output
    first, second, third = (SENTINELS[s].decode() for s in ORDERS[form])
    head, _, rest = output[3:].partition(second)
    between, _, tail = rest.partition(third)
    parts = dict(zip(ORDERS[form], (head, between, tail), strict=True))
    return parts[PREFIX] + parts[MIDDLE] + parts[SUFFIX]


def _schema(ddl: str, docs: DataFrame, doc_id: str) -> StructType:
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(f"doc_id {docs.schema[doc_id].dataType.simpleString()}, {ddl}")


class _Rows:
    """Rows gathered into record batches of at most ``limit`` bytes of pieces."""

    def __init__(self, schema: StructType, limit: int = 4 << 20):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.schema, self.limit, self.rows, self.size = to_arrow_schema(schema), limit, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size > self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0


def cut_pieces(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rate: int = 90, spm_rate: int = 20, seed: str = "1", piece_units: int = PIECE_UNITS) -> DataFrame:
    """Pieces (doc_id, key, pos, piece, n, form, prefix_chars, middle_chars); the last four stand on a document's first piece."""
    schema = _schema(f"key binary, pos long, piece binary, {FACTS}", docs, doc_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        for batch in batches:
            for doc, body in zip(batch.column(0), batch.column(1), strict=True):
                doc, body = doc.as_py(), body.as_py() or b""
                facts, pieces = cut_text(doc, body, rate=rate, spm_rate=spm_rate, seed=seed, piece_units=piece_units)
                key = hashlib.md5(f"{doc is None}{doc}:".encode() + body, usedforsecurity=False).digest()
                for pos, piece in enumerate(pieces):
                    yield from out.add((doc, key, pos, piece, *(facts if pos == 0 else (None,) * 4)), len(piece))
        yield from out.flush()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("body")).mapInArrow(run, schema)


def _distinct_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
    """Sorted rows without repetition, each with the number of equal rows at its key and position."""
    held, copies = None, 0
    for batch in batches:
        for row in batch.to_pylist():
            if held is not None and row["key"] == held["key"] and row["pos"] == held["pos"]:
                copies += 1
                continue
            if held is not None:
                yield held, copies
            held, copies = row, 1
    if held is not None:
        yield held, copies


def in_output_order(pieces: DataFrame) -> DataFrame:
    """All pieces of a document in one partition, in the order of its output."""
    return pieces.repartition("key").sortWithinPartitions("key", "pos")


def assemble(ordered: DataFrame) -> DataFrame:
    """Output digests, and the pieces with their place in the original.

    Rows are pieces (doc_id, key, place, piece) without sentinels, and one closing row per document, placed
    last, with its facts, ``output_sha256`` and ``copies``, the number of equal rows.
    """
    schema = _schema(f"key binary, place long, piece binary, {FACTS}, output_sha256 string, copies long", ordered, "doc_id")
    blank = (None,) * 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = _Rows(schema), None
        for row, copies in _distinct_pieces(batches):
            if row["pos"] == 0:
                if now is not None:
                    yield from out.add((*now, digest.hexdigest(), times), 0)
                now = (row["doc_id"], row["key"], LAST, None, row["n"], row["form"], row["prefix_chars"], row["middle_chars"])
                digest, sections, times = hashlib.sha256(), Sections(row["form"]), copies
            digest.update(row["piece"])
            section, body = sections.take(row["piece"])
            yield from out.add((None, row["key"], section << 40 | row["pos"], body, *blank), len(body))
        if now is not None:
            yield from out.add((*now, digest.hexdigest(), times), 0)
        yield from out.flush()

    return ordered.mapInArrow(run, schema)


def restore_digests(assembled: DataFrame) -> DataFrame:
    """One row per document: its facts, ``output_sha256`` and ``restored_sha256``."""
    schema = _schema(f"{FACTS}, output_sha256 string, restored_sha256 string", assembled, "doc_id")
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest = _Rows(schema), hashlib.sha256()
        for batch in batches:
            for row in batch.to_pylist():
                if row["place"] != LAST:
                    digest.update(row["piece"])
                    continue
                for _ in range(row["copies"]):
                    yield from out.add((*(row[c] for c in names), digest.hexdigest()), 0)
                digest = hashlib.sha256()
        yield from out.flush()

    return assembled.sortWithinPartitions("key", "place").mapInArrow(run, schema)


def fill_in_middle(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 for each document."""
    return restore_digests(assemble(in_output_order(cut_pieces(docs, **options))))


def output_texts(docs: DataFrame, **options) -> DataFrame:
    """The training texts themselves: doc_id, form, output. A task holds one output at a time."""
    ordered = in_output_order(cut_pieces(docs, **options))
    schema = _schema("form string, output string", ordered, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = _Rows(schema), None

        def close() -> Iterator[pa.RecordBatch]:
            for _ in range(times):
                yield from out.add((*now, b"".join(body).decode()), sum(map(len, body)))

        for row, copies in _distinct_pieces(batches):
            if row["pos"] == 0:
                if now is not None:
                    yield from close()
                now, body, times = (row["doc_id"], row["form"]), [], copies
            body.append(row["piece"])
        if now is not None:
            yield from close()
        yield from out.flush()

    return ordered.mapInArrow(run, schema)
