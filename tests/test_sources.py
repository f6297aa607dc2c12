"""Scans of an export on disk, validation, sinks."""

import json

import pytest
from corpuswright import schemas
from corpuswright.operators import export as xp
from corpuswright.operators import runs as rn
from corpuswright.operators import validation as va
from corpuswright.plans.enrich import enrich
from corpuswright.sources import scan, sinks
from pyspark.sql import functions as F


@pytest.fixture()
def export(tmp_path):
    root = tmp_path / "my export"
    rows = []
    for i in ("1", "2"):
        page = root / "pages" / i
        (page / "attachments").mkdir(parents=True)
        meta = dict(page_id=i, space_key="S", title=f"Page {i}", labels=["x"], content_hashes={"text_sha256": "t"}, unknown=1)
        (page / "metadata.json").write_text(json.dumps(meta, indent=1))
        (page / "links.json").write_text(json.dumps({"links": [{"href": "h", "text": "T"}]}))
        (page / "conversion.json").write_text(json.dumps({"warnings": ["w"] if i == "2" else []}))
        (page / "clean.md").write_bytes("# Page\n\ncafé ".encode() + b"\xff")
        (page / "text.txt").write_text("Page text\nsecond line")
        (page / "attachments" / "a b.png").write_bytes(b"1")
        (page / "attachments" / "manifest.json").write_text("{}")
        rows.append(dict(markdown_path=f"pages/{i}/clean.md", page_id=i, path=f"pages/{i}", space_key="S", status="success", title=f"Page {i}"))
    rows.append(dict(markdown_path="pages/3/clean.md", page_id="3", path="pages/3", space_key="S", status="failed", title="Page 3"))
    (root / "manifest.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n\n")
    (root / "dataset.json").write_text(json.dumps(dict(dataset_name="d", source="wiki")))
    (root / "manifest.summary.json").write_text(json.dumps(dict(spaces={"S": 3}, total_pages=3)))
    return root


def issues_of(spark, root):
    root = str(root)
    manifest = scan.good_rows(scan.scan_manifest(spark, root))
    meta = scan.scan_page_json(spark, root, "metadata.json", schemas.METADATA)
    links = scan.scan_page_json(spark, root, "links.json", schemas.LINKS)
    conv = scan.scan_page_json(spark, root, "conversion.json", schemas.CONVERSION)
    errors = scan.scan_export_errors(spark, root)
    issues = va.validate_corpus(manifest, scan.scan_files(spark, root), meta, links, conv, errors)
    return issues, va.validation_summary(manifest, issues, errors).first()


def test_whole_export(spark, export):
    pages = scan.scan_pages(spark, str(export)).orderBy("page_id").collect()
    assert [p.page_id for p in pages] == ["1", "2"]
    assert pages[0].attachment_names == ["a b.png"] and pages[0].text == "Page text\nsecond line"
    assert pages[0].markdown.startswith("# Page\n\ncafé") and pages[0].links[0].href == "h"
    assert scan.scan_dataset(spark, str(export)).first().dataset_name == "d"
    assert scan.scan_manifest_summary(spark, str(export)).first().spaces == {"S": 3}
    issues, summary = issues_of(spark, export)
    assert {(i.level, i.code, i.page_id) for i in issues.collect()} == {
        ("warning", "markdown_hash_missing", "1"), ("warning", "markdown_hash_missing", "2"), ("warning", "conversion_warnings_present", "2"),
    }
    assert (summary.pages_total, summary.pages_valid, summary.pages_failed, summary.ok) == (3, 2, 0, True)


def test_damaged_export(spark, export):
    (export / "pages" / "1" / "clean.md").unlink()
    (export / "pages" / "2" / "metadata.json").write_text("{oops")
    (export / "errors.jsonl").write_text('{"error": "x"}\n')
    with (export / "manifest.jsonl").open("a") as f:
        f.write('{"page_id": \n[1]\n')
    bad = scan.scan_manifest(spark, str(export)).where("_corrupt is not null").collect()
    assert sorted(b._corrupt for b in bad) == ['[1]', '{"page_id": ']
    issues, summary = issues_of(spark, export)
    found = {(i.code, i.page_id) for i in issues.where("level = 'error'").collect()}
    assert found == {("markdown_missing", "1"), ("metadata_invalid", "2")}
    assert (summary.pages_failed, summary.export_errors, summary.ok) == (2, 1, False)


def test_outputs_match_their_contracts(spark, make_pages, tmp_path):
    from corpuswright.operators.profile import signatures
    from corpuswright.operators.rollups import document_index_rows, fact_rows, quality_rows

    pages = make_pages()
    done = enrich(pages, "2024-01-30T00:00:00Z")
    tables = {
        "document_index": document_index_rows(done.pages, signatures(pages)),
        "quality_scores": quality_rows(done.pages),
        "facts": fact_rows(done.facts, done.pages),
    }
    sinks.write_index_tables(tables, str(tmp_path / "k"), run_id="r", dataset_name="d")
    back = scan.scan_index_tables(spark, str(tmp_path / "k"))
    assert schemas.contract_differences(back["document_index"], "document_index") == []
    assert back["document_index"].first().run_id == "r"
    assert back["facts"].where("confidence < 0.7").count() == 0 and back["evidence_hints"].count() > 0
    assert back["themes"].count() == 0
    assert set(schemas.table_contracts()) == set(schemas.CONTRACTS)


def test_rendered_export(spark, make_pages, tmp_path):
    pages = make_pages()
    done = enrich(pages, "2024-01-30T00:00:00Z").pages
    links = xp.link_lines(xp.source_link_ranking(pages))
    good = xp.export_eligibility(done, review_flags=["draft"]).where("eligible")
    row = xp.render_documents(good, pages, dataset_name="d", links=links, run_id="r").first()
    assert row.path == "d/OPS/1-payments-runbook-1-2.md"
    assert row.content.startswith('#DOCUMENT_METADATA={"approval_status":"unreviewed"')
    for part in ("## Key Facts", "- Page title: Payments Runbook 1.2", "> Image omitted from source export: Chart", "- Recovery runbook: https://x/runbook", "- Owner signal: present"):
        assert part in row.content, part
    assert "id: 1" not in row.content


def test_unknown_run_id_is_refused(spark):
    runs = spark.createDataFrame([("r1", "enrich"), ("r2", "report")], "run_id string, command string")
    assert [r.run_id for r in rn.select_runs(runs, run_ids=["r1"]).collect()] == ["r1"]
    with pytest.raises(ValueError, match="r2"):
        rn.select_runs(runs, run_ids=["r1", "r2"])


def test_salted_join_keeps_every_row(spark):
    from corpuswright.session import salted_join

    big = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    small = big.select("key").distinct().withColumn("v", F.length("key"))
    got = salted_join(big, small, "key", by=["id"], hot_rows=100)
    assert got.count() == 3000 and got.where("v is null or v <> length(key)").count() == 0


def test_unreadable_earlier_files_count_as_absent(spark, tmp_path):
    root = str(tmp_path / "earlier")
    assert scan.scan_enrichments(spark, root) is None
    spark.createDataFrame([("a", "S"), ("b", "T")], "document_id string, space_key string").write.partitionBy("space_key").parquet(root)
    (tmp_path / "earlier" / "space_key=S" / "cut.parquet").write_bytes(b"PAR1 and then nothing")
    (tmp_path / "earlier" / "space_key=T" / "text.parquet").write_bytes(b"plain text " * 50)
    rows = scan.scan_enrichments(spark, root)
    assert sorted((r.document_id, r.space_key) for r in rows.collect()) == [("a", "S"), ("b", "T")]
    issues = scan.skipped_issues(scan.skipped_files(spark, root, rows)).collect()
    assert sorted(r.path.rsplit("/", 1)[-1] for r in issues) == ["cut.parquet", "text.parquet"]
    only = tmp_path / "broken"
    only.mkdir()
    (only / "x.parquet").write_bytes(b"nothing here")
    assert scan.scan_enrichments(spark, str(only)) is None
    assert scan.skipped_files(spark, str(only), None).count() == 1


def test_one_listing_opens_only_the_files_asked_for(spark, tmp_path):
    for i in range(6):
        folder = tmp_path / "pages" / str(i) / "attachments"
        folder.mkdir(parents=True)
        (folder.parent / "text.txt").write_text(f"page {i}")
        (folder.parent / "clean.md").write_text("# x")
        (folder / "big b+c.png").write_bytes(b"x" * 1000)
    (tmp_path / "pages" / "3" / "text.txt").write_bytes(b"bad \xff utf")
    tree = scan.scan_tree(spark, str(tmp_path))
    texts = scan.scan_page_text(spark, str(tmp_path), "text.txt", "text", tree=tree)
    assert {r.folder: r.text for r in texts.collect()}["pages/3"] == "bad � utf"
    leaf = texts._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numFiles").value() == 6
    files = scan.scan_files(spark, str(tmp_path), tree=tree)
    assert files.count() == 18 and "content" not in files._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        scan.scan_tree(spark, str(tmp_path / "absent"))


def test_pages_are_read_without_listing_the_tree(spark, export):
    # the driver would hold an entry for each file of every page
    (export / "pages" / "2" / "attachments" / "_tmp.png").write_bytes(b"1")
    with (export / "manifest.jsonl").open("a") as f:
        for path in ("pages/1", "pages/./1", "pages/9", "../export/pages/1"):
            f.write(json.dumps(dict(markdown_path="m", page_id="x", path=path, status="success")) + "\n")
    pages = scan.scan_pages(spark, str(export))
    assert "binaryFile" not in pages._jdf.queryExecution().toString()
    assert sorted(p.page_id for p in pages.collect()) == ["1", "1", "2"]
    assert {tuple(p.attachment_names) for p in pages.collect()} == {("a b.png",)}
    assert {tuple(p.attachment_names) for p in scan.scan_pages(spark, str(export), own_files=["a b.png"]).collect()} == {()}


def test_texts_of_pages_are_not_broadcast(spark, export):
    # their size is guessed by the manifest, which is small beside them
    pages = scan.scan_pages(spark, str(export))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted((p.page_id, p.text) for p in pages.collect()) == [(i, "Page text\nsecond line") for i in ("1", "2")]
