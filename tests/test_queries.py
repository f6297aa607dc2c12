"""Registered queries: plans without nested-loop joins, and a few results against SQL."""

import duckdb
import pytest
from checks import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = [
    "simhash_pairs", "title_families", "hierarchy_counts", "status_flags", "keyword_counts", "entity_rollup",
    "usage_report", "review_queue", "validate_corpus", "changed_only", "image_select", "validate_responses",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_every_query_has_a_counterpart_or_is_known():
    without = set(registry.queries()) - set(registry.oracle_sql())
    assert without <= registry.ROWS_ONLY
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, con, name):
    df = registry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    order = sorted(df.columns)
    rows = sorted(str([r[c] for c in order]) for r in df.collect())
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == order
    want = sorted(str([r[names.index(c)] for c in order]) for r in cur.fetchall())
    assert rows == want
