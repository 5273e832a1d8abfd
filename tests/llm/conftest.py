import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark):
    """A folder for checkpoints, where the session names none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="earshot-tests-"))


@pytest.fixture
def docs_of(spark):
    """Documents from texts, or from (id, text), (id, text, source)."""

    def make(rows, extra=""):
        full = [(i, r, "s") if not isinstance(r, tuple) else (*r, "s")[:3] for i, r in enumerate(rows)]
        docs = spark.createDataFrame(full, "doc_id bigint, text string, source string")
        return docs.selectExpr("*", extra) if extra else docs

    return make
