import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.codegen.wholeStage", "false")  # tiny data: compiling costs more than it saves
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "America/New_York")  # results must not depend on it
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


PAGE = dict(
    page_id="1", space_key="OPS", title="Payments Runbook 1.2", status="current", updated_at="2024-01-10T00:00:00Z",
    url="https://wiki/1", labels=["ops", "kafka queue"], ancestors=[("9", "Operations runbook")],
    content_hashes=("", None, "abc", None), links=[("external", "https://x/runbook", "Recovery runbook", None)],
    attachment_names=["diagram.png"],
    markdown="---\nid: 1\n---\n# Payments Runbook\n\n## Checks\nOwner: Team Alpha\nCheck the queue first.\n![Chart](attachments/diagram.png)\n",
    text="Payments Runbook\nOwner: Team Alpha\nSupport group: SRE L2\nCheck the queue first, then restart it.\n",
)


@pytest.fixture(scope="session")
def make_pages(spark):
    from corpuswright.operators.profile import document_key
    from corpuswright.schemas import PAGES

    def make(*changes):
        rows = [{**PAGE, **c} for c in (changes or ({},))]
        names = [f.split(" ")[0] for f in _fields(PAGES)]
        return document_key(spark.createDataFrame([tuple(r[n] for n in names) for r in rows], PAGES))

    return make


def _fields(ddl):
    from corpuswright.operators.inference import _split_ddl

    return _split_ddl(ddl)
