"""Text columns: normalisation, line and word splitting, Markdown pieces, hashes."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NON_ASCII = r"[^\x00-\x7F]"
# every separator that ends a line in Unicode text
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x85  ]"
RARE_BREAKS = ["\x0b", "\f", "\r", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]
WORD = r"[\p{L}\p{N}_][\p{L}\p{N}_'-]*"
NON_SPACE = r"(?U)[^\s\x1C-\x1F]+"
MARKDOWN_IMAGE = r"!\[([^\]]*)\]\(([^)]+)\)"
HEADING = r"(?U)^#{1,6}\s+(.+?)\s*$"


@lru_cache(maxsize=1)
def _compatibility_folding() -> tuple[str, str, dict[str, str]]:
    """ASCII remainders of every code point's compatibility decomposition.

    Returns (code points with one ASCII letter, those letters, code points with several).
    """
    single_from, single_to, several = [], [], {}
    for point in range(0x80, 0x110000):
        if 0xD800 <= point <= 0xDFFF:
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if ord(c) < 128)
        if len(plain) == 1:
            single_from.append(chr(point))
            single_to.append(plain)
        elif plain:
            several[chr(point)] = plain
    return "".join(single_from), "".join(single_to), several


def to_ascii(c: Column) -> Column:
    """Compatibility-decompose and drop what is left outside ASCII; ASCII rows pass through."""
    single_from, single_to, several = _compatibility_folding()
    table = F.from_json(F.lit(json.dumps(several)), "map<string,string>")
    ligature = "[" + "".join(several) + "]"
    unfolded = F.array_join(
        F.transform(
            F.regexp_extract_all(c, F.lit("(?s)(.)"), 1), lambda ch: F.coalesce(table[ch], ch)
        ),
        "",
    )

    def fold(value: Column) -> Column:
        return F.regexp_replace(F.translate(value, single_from, single_to), NON_ASCII, "")

    return F.when(~c.rlike(NON_ASCII), c).when(c.rlike(ligature), fold(unfolded)).otherwise(fold(c))


def normalize_term(c: Column) -> Column:
    """Lower-case ASCII words joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(to_ascii(c)), "[^a-z0-9]+", " "))


def slugify(c: Column, max_chars: int = 90) -> Column:
    """Lower-case ASCII words joined by hyphens, cut to ``max_chars``; ``untitled`` if empty."""
    joined = F.replace(normalize_term(c), F.lit(" "), F.lit("-"))
    cut = F.rtrim(F.substring(joined, 1, max_chars), F.lit("-"))
    return F.when(cut == "", F.lit("untitled")).otherwise(cut)


SPACES = "".join(chr(point) for point in range(0x110000) if chr(point).isspace())


def strip(c: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.trim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    """Collapse white space runs to one blank."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def lines(c: Column) -> Column:
    """Lines of ``c``; only texts with a rare separator need the slower split."""
    return F.when(contains_any(c, RARE_BREAKS), F.split(c, LINE_BREAK)).otherwise(F.split(c, "\n"))


def strip_front_matter(c: Column) -> Column:
    """Cut a leading ``---`` block that is closed; keep the text as it is otherwise."""
    close = F.locate("\n---\n", c, 5)
    body = F.substring(c, close + 5, F.length(c))
    return F.when(c.startswith("---\n") & (close > 0), F.ltrim(body, F.lit("\n"))).otherwise(c)


def extract_headings(c: Column) -> Column:
    return F.transform(
        F.filter(lines(c), lambda line: line.startswith("#") & line.rlike(HEADING)),
        lambda line: strip(F.regexp_extract(line, HEADING, 1)),
    )


def word_count(c: Column) -> Column:
    """Words with letters, digits, ``_``, ``'`` and ``-`` (used by the scores)."""
    return F.regexp_count(c, F.lit(WORD))


def token_count(c: Column) -> Column:
    """White-space separated tokens (used by the index table)."""
    return F.regexp_count(c, F.lit(NON_SPACE))


def display_title(c: Column) -> Column:
    """Title without a leading outline number such as ``3.1.2``."""
    cut = strip(F.regexp_replace(c, r"(?U)^\s*\d+(?:\.\d+)*\.?\s+", ""))
    return F.when(cut == "", c).otherwise(cut)


def rewrite_images(c: Column) -> Column:
    """Replace Markdown images by a line naming the alternative text or the file."""
    note = "> Image omitted from source export: "
    with_alt = F.regexp_replace(c, r"(?U)!\[\s*([^\]\s](?:[^\]]*[^\]\s])?)\s*\]\([^)]+\)", note + "$1")
    # the file name is the last path segment before the query, ignoring closing slashes
    with_file = F.regexp_replace(
        with_alt,
        r"(?U)!\[\s*\]\(\s*(?:[^)?]*/)?([^)?/]*[^)?/\s])/*\s*(?:\?[^)]*)?\)",
        note + "$1",
    )
    return F.regexp_replace(with_file, r"!\[[^\]]*\]\([^)]+\)", note + "image")


def contains_any(c: Column, terms) -> Column:
    """True when any of ``terms`` occurs anywhere in ``c`` (substring, not word)."""
    return any_of(terms, c.contains)


def any_of(terms, has) -> Column:
    """True when ``has(term)`` holds for any of ``terms``, where a term with another of them inside need not be asked for."""
    found = F.lit(False)
    for term in dict.fromkeys(terms):
        if not any(other != term and other in term for other in terms):
            found = found | has(term)
    return found


@lru_cache(maxsize=64)
def _stems(terms: tuple[str, ...]) -> dict[str, str]:
    """Term to a beginning of one of its words, four letters at least, that other terms have, too."""
    covered: dict[str, set[str]] = {}
    for term in terms:
        for at in range(len(term)):
            if at == 0 or term[at - 1] == " ":
                for to in range(at + 4, len(term) + 1):
                    covered.setdefault(term[at:to], set()).add(term)
    left, stems = set(terms), {}
    while covered:
        stem = max(covered, key=lambda s: (len(covered[s] & left), len(s), s))
        if len(covered[stem] & left) < 2:
            break
        stems |= dict.fromkeys(covered[stem] & left, stem)
        left -= covered[stem]
    return stems


def with_stems(df: DataFrame, name: str, terms):
    """``df`` with a column for each stem that several ``terms`` share, the test whether column ``name`` contains
    a term, and the names of the new columns; a text without the stem is not searched for its terms."""
    stems = _stems(tuple(dict.fromkeys(terms)))
    columns = {stem: f"_stem{i}" for i, stem in enumerate(sorted(set(stems.values())))}

    def has(term: str) -> Column:
        stem = stems.get(term)
        return F.col(name).contains(term) if stem is None else F.col(columns[stem]) if stem == term else F.col(columns[stem]) & F.col(name).contains(term)

    return df.withColumns({column: F.col(name).contains(stem) for stem, column in columns.items()}), has, list(columns.values())


def hamming(left: Column, right: Column) -> Column:
    """Bit distance of two 64-bit hex strings; 64 when one is not a hex number."""

    def bits(c: Column) -> Column:
        return F.conv(c, 16, -10).cast("bigint")

    valid = left.rlike("^[0-9a-fA-F]{1,16}$") & right.rlike("^[0-9a-fA-F]{1,16}$")
    return F.when(valid, F.bit_count(bits(left).bitwiseXOR(bits(right)))).otherwise(F.lit(64))


def unique_filtered(c: Column) -> Column:
    """First occurrence of every non-empty entry, in order."""
    return F.filter(F.array_distinct(c), lambda v: v.isNotNull() & (v != ""))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (also inside higher-order functions)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def first_by_key(values: Column, key, limit: int | None = None) -> Column:
    """Order-preserving distinct on ``key(value)`` of a short list; empty keys dropped."""

    def pick(s: Column) -> Column:
        kept = F.filter(
            s["values"],
            lambda v, i: (F.element_at(s["keys"], i + 1) != "")
            & (F.array_position(s["keys"], F.element_at(s["keys"], i + 1)) == i + 1),
        )
        return F.slice(kept, 1, limit) if limit is not None else kept

    return let(F.struct(values.alias("values"), F.transform(values, key).alias("keys")), pick)


def coalesce_array(c: Column, kind: str = "string") -> Column:
    return F.coalesce(c, F.array().cast(f"array<{kind}>"))


def head(c: Column, n: int | None) -> Column:
    """The first ``n`` characters, or all of them without a limit."""
    return c if n is None else F.substring(c, 1, n)


def first(c: Column, n: int | None) -> Column:
    """The first ``n`` elements of an array, or all of them without a limit."""
    return c if n is None else F.slice(c, 1, n)
