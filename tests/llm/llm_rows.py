"""Rows that every operator must take, and a fixture that makes documents of them."""

import pytest
from pyspark.sql import types as T

DATA = "/root/testdata/sf0.01"

# Null, empty and very long texts, repeated rows, null ids, white space only.
LONG = "word " * 60_000
EDGES = [(1, None), (2, ""), (3, LONG), (4, "same text here"), (4, "same text here"), (None, "no id at all"),
         (None, None), (5, " \n\t ")]


@pytest.fixture(scope="session")
def documents(spark):
    """Make rows of `documents`; extra columns clash with names that operators use."""

    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        kind = T.StructType.fromDDL(
            "doc_id bigint, text string, lang string, source string, n_chars bigint, "
            "verdict int, score int, _row string, _features string, id string, label string, kept string"
        )
        full = []
        for doc_id, text, *source in rows:
            n = None if text is None else len(text)
            full.append((doc_id, text, "en", source[0] if source else "s", n, 1, 2, "r", "f", "i", "l", "k"))
        return spark.createDataFrame(full, kind)

    return make
