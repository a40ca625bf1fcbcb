from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return SF


@pytest.fixture(scope="session")
def documents(sf):
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that every operator must bear: nulls in any column, empty, blank
    and very long texts, repeated rows, a repeated id, extra columns."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. " * 3, "en", "s", 1, "x"),
        (1, "The quick brown fox jumps over the lazy dog. " * 3, "en", "s", 1, "x"),
        (2, None, None, None, None, None),
        (3, "", "en", "s", 0, "y"),
        (4, " \n\t ", "en", None, 3, "y"),
        (None, "no id at all, but a text with an address a.b@c.de", None, "s", 9, None),
        (None, None, None, None, None, None),
        (5, "word " * 40000, "en", "s", 200000, "z"),
        (6, "x" * 30000, None, "s", 30000, "z"),
        (7, "日本語のテキスト 🙂 12.34.56.78", "ja", "s", 20, "z"),
        (7, "another text under the same id", "en", "s", 30, "z"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
