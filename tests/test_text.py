"""Column functions against plain Python definitions."""

import hashlib
import re
import unicodedata
from datetime import UTC, datetime

from corpuswright.functions import text as tx
from corpuswright.functions.times import age_days, instant, parse_timestamp
from pyspark.sql import functions as F

TITLES = [
    "straße ﬁn Ⅳ ½", "Café  №5 — ＡＢＣ", "", "plain ASCII title", "  Ünïcödé\tx ", "日本語 text", "ﬃ 𝐀𝐁 ①",
    "a-b_c.d/e", "été", "ﬀ", "---",
]


def one(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", column(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def fold(value):
    return unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()


def test_normalize_term_folds_like_nfkd(spark):
    want = [re.sub(r"[^a-z0-9]+", " ", fold(v).lower()).strip() for v in TITLES]
    assert one(spark, TITLES, tx.normalize_term) == want


def test_normalize_term_on_every_code_point_block(spark):
    blocks = ["".join(chr(c) for c in range(s, s + 64) if not 0xD800 <= c <= 0xDFFF) for s in range(0x80, 0x1F900, 64)]
    blocks = [b for b in blocks if b]
    want = [re.sub(r"[^a-z0-9]+", " ", fold(v).lower()).strip() for v in blocks]
    assert one(spark, blocks, tx.normalize_term) == want


def test_slugify(spark):
    assert one(spark, ["Hello, World!", "日本", "a b c d"], lambda c: tx.slugify(c, 5)) == ["hello", "untitled", "a-b-c"]


def test_front_matter(spark):
    texts = ["---\na: 1\n---\n\nbody", "---\nopen", "no matter", "---\n---\nx", "---\na\n---\n"]

    def plain(md):
        if not md.startswith("---\n"):
            return md
        end = md.find("\n---\n", 4)
        return md if end == -1 else md[end + 5 :].lstrip("\n")

    assert one(spark, texts, tx.strip_front_matter) == [plain(t) for t in texts]


def test_headings_and_words(spark):
    md = "# One\ntext # no\n###   Two  \n####### seven\n#none\n## Drei\x0b# Vier"
    assert one(spark, [md], tx.extract_headings) == [["One", "Two", "Drei", "Vier"]]
    texts = ["été it's foo-bar _x -- '' a--b 12", "straße—naïve", ""]
    assert one(spark, texts, tx.word_count) == [len(re.findall(r"\b[\w'-]+\b", t)) for t in texts]
    assert one(spark, texts, tx.token_count) == [len(t.split()) for t in texts]


def test_rewrite_images(spark):
    def plain(md):
        def note(m):
            name = m.group(2).strip().split("?", 1)[0].rstrip("/").rsplit("/", 1)[-1] or "image"
            return f"> Image omitted from source export: {m.group(1).strip() or name}"

        return re.sub(r"!\[([^\]]*)\]\(([^)]+)\)", note, md)

    texts = ["a ![ Alt x ](u.png) b", "![](http://h/p/f.png?v=1)", "![ ](x.png)", "![](dir/)", "![](/)", "![a](b) ![](c/d.gif)"]
    assert one(spark, texts, tx.rewrite_images) == [plain(t) for t in texts]


def test_hamming(spark):
    df = spark.createDataFrame([("ffffffffffffffff", "0" * 16), ("0f", "0e"), ("zz", "01")], "a string, b string")
    assert [r[0] for r in df.select(tx.hamming(F.col("a"), F.col("b"))).collect()] == [64, 1, 64]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    values = [
        "2024-01-30T10:00:00Z", "2024-01-30T10:00:00+02:00", "2024-01-30T10:00:00", "2024-01-30", "2024-01-30T10:00:00.5Z",
        "nope", "", "2024-13-01", "2024-01-28T12:00:01Z", "2024-02-01T00:00:00Z",
    ]
    seconds = one(spark, values, lambda c: F.unix_seconds(parse_timestamp(c)))

    def plain(v):
        try:
            d = datetime.fromisoformat(v.replace("Z", "+00:00"))
        except ValueError:
            return None
        return int((d if d.tzinfo else d.replace(tzinfo=UTC)).timestamp())

    assert seconds == [plain(v) for v in values]
    days = one(spark, values[-2:], lambda c: age_days(c, instant("2024-01-30T12:00:00Z")))
    assert days == [1, -2]


def test_first_by_key_keeps_first_form(spark):
    df = spark.createDataFrame([(["B b", "a", "b  B", "", "A", "c"],)], "v array<string>")
    got = df.select(tx.first_by_key(F.col("v"), tx.normalize_term, 2)).first()[0]
    assert got == ["B b", "a"]


def test_simhash_matches_its_definition(spark):
    from corpuswright.operators.profile import simhash64

    texts = ["", "ab", "The quick brown fox jumps over the lazy dog " * 3, "été naïve straße", "one two three two one"]

    def plain(text):
        tokens = re.findall(r"[a-z0-9]{3,}", text.lower())
        if not tokens:
            return "0" * 16
        weight = [0] * 64
        for t in tokens:
            h = int(hashlib.sha256(t.encode()).hexdigest()[:16], 16)
            for b in range(64):
                weight[b] += 1 if h >> b & 1 else -1
        return f"{sum(1 << b for b in range(64) if weight[b] >= 0):016x}"

    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "document_id string, text string")
    got = {r["document_id"]: r["simhash"] for r in simhash64(df, "text").collect()}
    assert got == {str(i): plain(t) for i, t in enumerate(texts)}


def test_lines_end_at_every_separator(spark):
    texts = ["a\nb", "a\r\nb\x0bc", "a\x85b\n\nc", "a\u2028b\u2029", "", "a\x1cb\x1dc\x1ed\x0c", "\n", "\r"]
    assert one(spark, texts, tx.lines) == [re.split(tx.LINE_BREAK, t) for t in texts]
    df = spark.createDataFrame([("a",)], "v string").select(tx.lines(F.col("v")).alias("o"))
    assert "RLIKE" not in df._jdf.queryExecution().optimizedPlan().toString() and one(spark, [None], tx.lines) == [None]
    many = spark.createDataFrame([("a\nb",)], "v string").select(F.split("v", tx.LINE_BREAK).alias("o"), tx.lines(F.col("v")).alias("p")).first()
    assert many.o == many.p
