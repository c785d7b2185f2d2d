from __future__ import annotations

import pytest

LONG = "Thand ofer, ingare! " * 6000

ROWS = [
    (1, "The password: hunter2secret and the rest of a text", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n ", "fr", "b"),
    (5, LONG, "en", "b"),
    (6, "The password: hunter2secret and the rest of a text", "en", "a"),
    (6, "The password: hunter2secret and the rest of a text", "en", "a"),
    (7, "les eaux de la mer sont très bleues et les poissons aussi", "fr", None),
    (8, "12345 !!! 678", None, "c"),
    (None, "a row without an id", "en", "c"),
    (9, "日本語 и русский, ελληνικά", None, "c"),
]
# names the operators use inside, as columns of the input
CLASHES = ("fp", "size", "key", "h", "shard", "slot", "spans", "found", "nth", "part", "guest", "target", "number", "bytes", "row")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, and columns with the operators' own names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    rows = [(*row, len(row[1]) if row[1] is not None else None, *["x"] * len(CLASHES)) for row in ROWS]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row.doc_id: row.text for row in documents.select("doc_id", "text").collect()}
