from __future__ import annotations

import pytest
from pyspark.sql import functions as F

# Columns that operators use inside, as extra columns of their input.
CLASHES = ("_id", "_hash", "_text_hash", "row", "rows", "code", "size", "start", "number", "shard", "slot", "kept", "id_", "_row", "_cell")


def clashing(frame):
    return frame.select("*", *[F.lit("extra").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls everywhere, empty and blank texts, repeated rows, ties, a very long text, extra columns."""
    long_text = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
    rows = [
        (1, "", "en", "a", 0), (2, None, "en", None, None), (None, "one two three four", None, "b", 18),
        (None, None, None, None, None), (3, " \t\n ", "en", "a", 4), (4, "same text here twice over", "en", "a", 25),
        (4, "same text here twice over", "en", "a", 25), (5, "same text here twice over", "fr", "b", 25),
        (6, long_text, "en", "a", len(long_text)), (7, "é ñ ß 漢字 \U0001f600", "fr", "c", 12), (8, "x", "en", "c", 1),
    ]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3))


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
