"""WARC: magic inside payloads, revisits, odd rows, exact round trip."""

import uuid

import pytest

pytest.importorskip("corpuswright.llm")
from corpuswright.llm.warc import MAGIC, archive_round_trip, dedupe_payloads, read_archives, write_archives  # noqa: E402
from corpuswright.session import shared_dir  # noqa: E402

SCHEMA = "page_id long, url string, html string, payload string"


def trip(spark, rows, **options):
    pages = spark.createDataFrame(rows, SCHEMA)
    folder = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    write_archives(dedupe_payloads(pages.repartition(3)), folder, **options)
    return read_archives(spark, folder, with_payload=True).collect()


def test_magic_inside_payload_is_no_record(spark):
    fake = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a", "x" * 200 + fake + "é" * 50 + fake, None), (2, "u", MAGIC, None), (3, None, "\r\n\r\n", "clash"), (4, "a b\r\nc", None, None)]
    got = {r.page_id: r for r in trip(spark, rows, records_per_file=2)}
    assert set(got) == {1, 2, 3, 4}
    for page_id, _, html, _ in rows:
        assert bytes(got[page_id].payload).decode() == (html or "")
        assert got[page_id].intact
    assert got[4].url == "a%20b%20%20c"


def test_revisits(spark):
    same, short = "y" * 100, "z" * 99
    rows = [(5, "a", same, None), (3, "b", same, None), (9, "c", same, None), (1, "d", short, None), (2, "e", short, None), (None, "f", same, None)]
    got = {r.page_id: (r.record_type, r.refers_to) for r in trip(spark, rows)}
    assert got == {3: ("response", None), 5: ("revisit", 3), 9: ("revisit", 3), None: ("revisit", 3), 1: ("response", None), 2: ("response", None)}


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a", "k" * 150, None)] * 3 + [(None, None, None, None)] * 2
    got = sorted((r.page_id or 0, r.record_type) for r in trip(spark, rows))
    assert got == [(0, "response")] * 2 + [(1, "response")] * 3
    assert archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_payload_split_over_read_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = [(i, f"u{i}", (f"{i} é " * (50 + 400 * (i % 7))) + MAGIC * (i % 3), None) for i in range(60)]
        got = trip(spark, rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.page_id: bytes(r.payload).decode() for r in got} == {i: html for i, _, html, _ in rows}
    assert all(r.intact for r in got)


def test_second_scan_with_other_read_splits(spark):
    # a third of the payloads holds the magic; their texts are read again after the splits have changed
    html = [f"{i} é " * 40 + (f"{MAGIC}inside {i} " * (i % 4 + 1) if i % 3 == 0 else "") for i in range(200)]
    pages = spark.createDataFrame([(i, f"u{i}", h, None) for i, h in enumerate(html)], SCHEMA)
    folder = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    write_archives(dedupe_payloads(pages.repartition(3)), folder)
    for with_payload in (False, True):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        try:
            found = read_archives(spark, folder, with_payload=with_payload)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
            got = found.collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(got) == 200 and all(r.intact for r in got)
        if with_payload:
            assert {r.page_id: bytes(r.payload).decode() for r in got} == dict(enumerate(html))
