"""Personal data against a plain Python reading of the patterns, and disclosive words."""

import hashlib
import math
import random
import re

import pytest

pytest.importorskip("corpuswright.llm")
from pyspark.sql import functions as F  # noqa: E402

from corpuswright.llm.pii import evidence, find_private, sanitise, span_report  # noqa: E402

KINDS = ["email", "ip", "card", "phone"]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = [int(x) for x in reversed(d)]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(s)) % 10 == 0


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in v.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 10 <= len(d) <= 15


def expected(text):
    found = [(m.start(), KINDS.index(k), m.end()) for k in KINDS for m in re.finditer(PLAIN[k], text or "") if valid(k, m.group())]
    return sorted(found)


TEXTS = [
    None, "", "no data", "mail a.b+c@x-y.example.com, or b@c.d_e@f.g h@i", "@a.b a@b a@b. a@b.c.d.e..f x@y.z@w.v",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.3.4 999.1.1.1.1 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 12  4111111111111111",
    "4337166598464399 49443394904296051234 1 2 3 4 5 6 7 8 9 0 1 2 3 4", "+1 (988) 555-2485 +1 (98 +49-30-1234567890123456 ++12 345 678 90.",
    "é" * 50 + "ü@ä.de a@b.co é 192.168.0.1\n+1 (988) 555-2485\u0001 a@b.co\u0002", "a@b" + ".c" * 3000 + " x", "9" * 5000 + ".1.1.1 " + "1.2.3.4 " * 700, "z" * 20000 + "@",
    "+" * 30 + "1" * 12, "1.1.1.1" * 300, "x@y.zz 10.0.0.1 4111111111111111 +1 2345678901 " * 40,
]


def test_base_spans_equal_the_plain_patterns(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, spans string")
    found, _ = find_private(docs)
    for r in span_report(found).collect():
        want = expected(TEXTS[r.doc_id])
        text = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (r.doc_id, r.spans[:300], text[:300])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]


def test_words_that_give_an_entity_away(spark):
    own = [f"the speaker {w} Zarathustra met boss@corp.example near the {v} river" for w, v in zip("alpha beta gamma delta".split(), "blue green brown black".split())]
    rest = [f"the speaker met others number {i} near the river" for i in range(400)]
    copies = ["Copyword appears with copy@corp.example only"] * 30
    rows = [(i, t) for i, t in enumerate(own + rest + copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, terms = find_private(docs)
    assert {(r.value, r.term) for r in terms.collect()} == {("boss@corp.example", "zarathustra")}
    report = {r.doc_id: r.spans for r in span_report(found).collect()}
    for i, t in enumerate(own):
        assert f"term:{t.index('Zarathustra')}:{t.index('Zarathustra') + 11}" in report[i]
    assert all("term" not in s for i, s in report.items() if i >= len(own))
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert clean[0] == "the speaker alpha [NAME] met [EMAIL] near the blue river"
    assert clean[4] == rest[0] and len(clean) == len(rows)


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert span_report(find_private(empty)[0]).count() == 0 and sanitise(empty).count() == 0
    twice = spark.createDataFrame([(1, "a@b.cc"), (1, "a@b.cc"), (None, None)], "doc_id long, text string")
    assert sorted(r.n_email for r in span_report(find_private(twice)[0]).collect()) == [0, 1, 1]
    assert sanitise(twice.withColumn("_row", F.lit(1))).columns == ["doc_id", "text", "_row"]


def test_words_far_away_short_with_digits_and_in_other_documents(spark):
    filler = "and so on " * 12
    own = [f"Li met {filler} {w} boss@corp.example Zarathustra" for w in ["alpha", "beta", "gamma", "delta"]]
    codes = [f"code X9y {filler} {w} +1 (988) 555-2485" for w in ["alpha", "beta", "gamma"]]
    rest = [f"others met and so on alpha beta gamma delta code {i}" for i in range(4000)]
    rows = [(i, t) for i, t in enumerate([*own, *codes, "only Zarathustra was there", *rest])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, terms = find_private(docs)
    assert {r.term for r in terms.collect()} == {"li", "zarathustra", "x9y"}
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert clean[0] == f"[NAME] met {filler} alpha [EMAIL] [NAME]"
    assert clean[4] == f"code [NAME] {filler} alpha [PHONE]"
    assert clean[7] == "only [NAME] was there" and clean[8] == rest[0]
    report = {r.doc_id: r.spans for r in span_report(found).collect()}
    assert report[7] == "term:5:16" and report[8] == ""


def test_a_footer_address_discloses_no_rare_word(spark):
    # an address in half of the documents, and rare words in three documents each, wherever they fall
    rng = random.Random(3)
    said = [["some", "plain", f"text{i}", "write", "to"] for i in range(600)]
    for w in range(900):
        for i in rng.sample(range(600), 3):
            said[i].append(f"rare{w}x")
    for i in rng.sample(range(20), 5):
        said[i].append("Giveaway owner@corp.example")
    rows = [(i, " ".join(words) + (" info@corp.example" if i % 2 else "")) for i, words in enumerate(said)]
    _, terms = find_private(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.value, r.term) for r in terms.collect()} == {("owner@corp.example", "giveaway")}


def test_evidence_bounds_the_binomial_tail(spark):
    rows = [(both, n, v) for n in (3, 8, 20) for both in (n // 2, n - 1, n) for v in (5, 50, 200)]
    df = spark.createDataFrame(rows, "both long, n_term long, n_value long")
    for r in df.withColumn("e", evidence(F.col("both"), F.col("n_term"), F.col("n_value"), F.lit(400.0))).collect():
        p = r.n_value / 400
        tail = sum(math.comb(r.n_term, k) * p**k * (1 - p) ** (r.n_term - k) for k in range(r.both, r.n_term + 1))
        assert tail <= math.exp(-r.e) * (1 + 1e-9)
