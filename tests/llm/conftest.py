from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators give to columns of their own.
CLASHING = ("n_words", "kept", "failed", "size", "shard", "slot", "score", "held_out", "spans", "n_bytes", "rate", "copies", "list")


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def pages(spark):
    return spark.read.parquet(f"{SF_DIR}/pages.parquet")


@pytest.fixture
def awkward(spark):
    """NULLs in every column, empty, blank and very long texts, ties, repeated rows and clashing column names."""
    long = " ".join(f"word{i % 5000} and" for i in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs on", "en", "a", 55),
        (1, "the quick brown fox jumps over the lazy dog and runs on", "en", "a", 55),
        (2, "the quick brown fox jumps over the lazy dog and runs on", "en", "b", 55),
        (3, None, None, None, None),
        (None, "a text without an id", "en", None, 20),
        (None, None, None, "a", 0),
        (4, "", "en", "b", 0),
        (5, " \n\t ", "en", "b", 4),
        (6, long, "en", "a", len(long)),
        (7, long + " end", "en", "c", len(long) + 4),
        (8, "naïve café \U0001f600 你好世界 " * 30, "fr", "é", 480),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.selectExpr("*", *[f"'x' AS {name}" for name in CLASHING])


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCS)
