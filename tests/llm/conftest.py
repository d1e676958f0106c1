from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, source]) rows."""

    def make(*rows):
        full = [
            (row[0], row[1], "en", row[2] if len(row) > 2 else "a", None if row[1] is None else len(row[1])) for row in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name, sf="sf0.001": spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
