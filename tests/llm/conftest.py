"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(*rows):
        full = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
