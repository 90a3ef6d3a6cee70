from __future__ import annotations

import pytest
from hypothesis import settings

# First calls load code; a busy machine is not an error.
settings.register_profile("unhurried", deadline=None)
settings.load_profile("unhurried")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, with ids from 1 unless pairs of id and text are given."""
    def make(texts, schema: str = DOCS, source: str | None = "s"):
        rows = []
        for k, item in enumerate(texts, 1):
            doc_id, text = item if isinstance(item, tuple) else (k, item)
            rows.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(rows, schema)
    return make
