from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitchflow.llm.common import ship_code  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table from (doc_id, text) pairs."""
    ship_code(spark)

    def make(rows):
        full = [(d, t, "en", "src0", None if t is None else len(t)) for d, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def sf_docs(spark):
    """The documents of the smallest tables, in four input partitions."""
    ship_code(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4, "doc_id")
