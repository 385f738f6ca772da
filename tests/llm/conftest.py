from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows of documents from texts; ids count from 0 unless given."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make
