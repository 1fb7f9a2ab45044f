from __future__ import annotations

import pytest

KIND = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, doc string, k string"
LONG = ("word " * 30 + "\n") * 3000


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties
    and extra columns whose names operators use themselves."""
    shared = "This line is held by very many documents"
    rows = [
        (0, None, "en", "a"),
        (1, "", None, "a"),
        (2, "  \n\t\n", "en", None),
        (3, LONG, "en", "b"),
        (4, "one two three", "de", "b"),
        (4, "one two three", "de", "b"),
        (5, "one two three", None, None),
        (None, "no id here, but a text of more than five words", "en", "a"),
        (None, None, None, None),
        (6, f"first\n{shared}\nlast", "en", "a"),
        (7, f"{shared}  \n{shared.upper()}", "en", "a"),
        (8, f"\t{shared}", "fr", "c"),
        (9, "x" * 50_000, "en", "a"),
        (10, "Ünïcödé 漢字 😀\r\n 123 ",  "en", "a"),
    ]
    return spark.createDataFrame([(d, t, x, s, None, "clash", "clash", "clash") for d, t, x, s in rows], KIND)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
