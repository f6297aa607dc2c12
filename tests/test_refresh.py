"""Incremental runs: equal to a full run column by column, and only changed texts are read."""

import pytest
from corpuswright.plans import refresh as rf
from corpuswright.plans.enrich import enrich, own_features
from corpuswright.operators import rollups as ro
from pyspark.sql import functions as F

AS_OF = "2024-01-30T12:00:00Z"


def tree(i, parent, **changes):
    return dict(
        page_id=str(i), title=f"Service page {i}", ancestors=[(str(parent), f"Runbook {parent}")] if parent is not None else [],
        content_hashes=("", None, f"h{i}", None), text=f"Owner: Team {i}\nuse the queue {i}", markdown=f"# Heading {i % 4}\n", labels=["ops", f"label{i % 3}"], **changes,
    )


def without_run_columns(df):
    return df.drop("parent", "signature")


def same(df, other):
    cols = sorted(df.columns)
    assert cols == sorted(other.columns)
    return sorted(str([r[c] for c in cols]) for r in df.collect()) == sorted(str([r[c] for c in cols]) for r in other.collect())


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "state")


def test_second_run_equals_a_full_run(make_pages, folder):
    first = [tree(0, None)] + [tree(i, i // 4) for i in range(1, 24)]
    rf.refresh(make_pages(*first), folder, AS_OF, buckets=4)
    # changed text, changed label, moved page, removed page, two new ones (one with children), no hash
    second = [dict(p) for p in first if p["page_id"] not in ("11", "1")]
    by_id = {p["page_id"]: p for p in second}
    by_id["5"].update(text="Other words entirely", content_hashes=("", None, "new", None))
    by_id["6"].update(labels=["deprecated"])
    by_id["20"].update(ancestors=[("2", "Runbook 2")])
    by_id["9"].update(content_hashes=("", None, "", None))
    second += [tree(30, 3), tree(31, 30)]
    now = make_pages(*second)
    seen = []

    def counted(pages, *args, **options):
        seen.append({r.page_id for r in pages.select("page_id").collect()})
        return own_features(pages, *args, **options)

    done = rf.refresh(now, folder, AS_OF, buckets=4, features=counted)
    assert seen == [{"5", "6", "20", "9", "30", "31"}]
    full = enrich(now, AS_OF, with_facts=False).pages
    assert same(without_run_columns(done.pages), full)
    assert same(rf.rolled_up(done, "themes"), ro.theme_rollup(full)) and same(rf.rolled_up(done, "concepts"), ro.concept_rollup(full))
    branches = {r.document_id.split(":")[-1]: r.branch for r in done.branches.collect()}
    assert {k for k, v in branches.items() if v == "recomputed"} == seen[0]
    # 0 lost the child 1, 3 got 30 and 5 lost 20: they and their children are placed anew. 2 lost 11 and got 20
    assert {"0", "2", "3", "12", "21"} <= {k for k, v in branches.items() if v == "placed"}
    assert branches["8"] == branches["16"] == "carried"
    # a third run without a change carries everything but the page without a hash
    seen.clear()
    third = rf.refresh(now, folder, AS_OF, buckets=4, features=counted)
    assert seen == [{"9"}] and third.pages.count() == len(second)
    # all pages go and another one comes
    now = make_pages(tree(70, None))
    done = rf.refresh(now, folder, AS_OF, buckets=4)
    full = enrich(now, AS_OF, with_facts=False).pages
    assert same(without_run_columns(done.pages), full) and same(rf.rolled_up(done, "themes"), ro.theme_rollup(full))


def test_settings_and_unfinished_states(spark, make_pages, folder):
    rows = make_pages(tree(1, None), tree(2, 1))
    rf.refresh(rows, folder, AS_OF, buckets=2)
    again = rf.refresh(rows, folder, AS_OF, buckets=2, settings={"rules": 2})
    assert {r.branch for r in again.branches.collect()} == {"recomputed"}
    rf._mark(spark, folder, False)
    assert not rf.has_state(spark, folder)
    done = rf.refresh(rows, folder, AS_OF, buckets=2, settings={"rules": 2})
    assert {r.branch for r in done.branches.collect()} == {"recomputed"} and done.pages.count() == 2
