"""The incremental run: an earlier state of the corpus, then the run on the corpus as it is."""

from __future__ import annotations

from checks.corpus import AS_OF, pages, with_corpus
from checks.q_classify import COUNTS, HIER, INSIDE, J, classify_ctes
from checks.q_extract import _CO, _TH, KW, taxonomy_ctes
from checks.q_jobs import scratch
from checks.q_reports import _roll
from corpuswright.plans.refresh import refresh, rolled_up
from pyspark.sql import functions as F

CHANGED, NEW, GONE = "n % 10 = 3", "n % 20 = 5", "n % 50 = 7"


def earlier(now):
    """The corpus before: a tenth of the pages said something else, some were not there, some are gone since."""
    words = F.concat(F.lit("Earlier words about the queue and the board "), F.col("page_id"))
    old = now.where(f"not ({NEW})").withColumns(
        {
            "source_content_hash": F.expr(f"if({CHANGED}, concat('sha256:old', n), source_content_hash)"),
            "title": F.when(F.expr(CHANGED), F.concat(F.lit("Earlier runbook "), "page_id")).otherwise(F.col("title")),
            "text": F.when(F.expr(CHANGED), words).otherwise(F.col("text")),
            "markdown": F.when(F.expr(CHANGED), F.concat(F.lit("# Earlier heading\n"), words)).otherwise(F.col("markdown")),
        }
    )
    gone = now.where(GONE).withColumns(
        {
            "page_id": F.concat(F.lit("old-"), "page_id"),
            "document_id": F.concat("document_id", F.lit("-old")),
            "title": F.concat(F.lit("Dropped page "), "page_id"),
        }
    )
    return old.unionByName(gone)


def second_run(spark, sf):
    now = pages(spark, sf)
    folder = f"{scratch(spark)}/state"
    for rows in (earlier(now), now):
        done = refresh(rows, folder, AS_OF, buckets=16, inside_domains=INSIDE)
    return done


def _pages(spark, sf):
    done = second_run(spark, sf)
    return done.pages.join(done.branches, "document_id").select(
        "document_id", "branch", "child_count", "sibling_count", "depth", "section_path", "page_role", "document_type", "keywords"
    )


def _terms(spark, sf):
    done = second_run(spark, sf)
    found = [
        rolled_up(done, kind).withColumnsRenamed({f"{name}_id": "id", name: "shown", f"normalized_{name}": "term"})
        for kind, name in (("themes", "theme"), ("concepts", "concept"))
    ]
    columns = ["id", "shown", "term", "document_count", "confidence"]
    return found[0].select(*columns).unionByName(found[1].select(*columns))


QUERIES = {"incremental_run": _pages, "incremental_terms": _terms}

# the rows of a full run on the corpus as it is
_DONE = """kdoc AS (SELECT cls.* REPLACE (CASE WHEN n % 29 = 0 AND document_type <> 'archive' THEN 'reference' ELSE document_type END AS document_type),
  coalesce(kw.terms, []::VARCHAR[]) AS keywords FROM cls LEFT JOIN kw USING (document_id))"""
_BRANCH = f"""
fam AS (SELECT parent, sum(d) AS d FROM (SELECT parent, 1 AS d FROM par JOIN base USING (document_id) WHERE {NEW}
  UNION ALL SELECT parent, -1 FROM par JOIN base USING (document_id) WHERE {GONE}) GROUP BY parent HAVING sum(d) <> 0),
fate AS (SELECT base.document_id, CASE WHEN {CHANGED} OR {NEW} OR source_content_hash = 'sha256:unknown' THEN 'recomputed'
  WHEN par.parent IN (SELECT parent FROM fam) OR base.page_id IN (SELECT parent FROM fam) THEN 'placed' ELSE 'carried' END AS branch
  FROM base JOIN par USING (document_id))"""
SQL = {
    "incremental_run": with_corpus(
        f"""SELECT kdoc.document_id, branch, hier.child_count, hier.sibling_count, depth, section_path, page_role, kdoc.document_type, {J('keywords')} AS keywords
        FROM kdoc JOIN hier USING (document_id) JOIN fate USING (document_id)""",
        KW, classify_ctes("corpus"), _DONE, COUNTS, HIER, _BRANCH,
    ),
    "incremental_terms": with_corpus(
        "SELECT theme_id AS id, theme AS shown, normalized_theme AS term, document_count, confidence FROM themes "
        "UNION ALL SELECT concept_id, concept, normalized_concept, document_count, confidence FROM concepts",
        KW, classify_ctes("corpus"), _DONE,
        taxonomy_ctes("kdoc", "document_id", _TH, "tt"), f"themes AS ({_roll('theme')})",
        taxonomy_ctes("kdoc", "document_id", _CO, "tc"), f"concepts AS ({_roll('concept').replace('FROM tt JOIN', 'FROM tc JOIN')})",
    ),
}
