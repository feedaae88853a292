import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session", autouse=True)
def _workers_import_the_package(spark):
    from seriesforge.llm.common import importable
    importable(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents with clashing extra columns from a list of texts or (id, text)."""
    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", None, 1, 2) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int, n bigint")
    return make
