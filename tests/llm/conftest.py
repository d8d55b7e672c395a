from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents-like frame from (doc_id, text) pairs, with columns that clash with internal names."""

    def make(rows, extra=True):
        schema = "doc_id long, text string" + (", _key string, _text string, n long" if extra else "")
        return spark.createDataFrame([(i, t, *(["k", "t", 7] if extra else [])) for i, t in rows], schema)

    return make
