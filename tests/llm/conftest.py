from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, hash int, node string"
LONG = "Word, another wörd. And\nthe next line " * 4000
ODD = [
    (1000, None, "en"), (1001, "", None), (1002, "   \n\t ", "en"), (1003, "12 !? 34", None), (1004, LONG, "en"),
    (1005, LONG, "en"), (1006, "the same of these five words", "en"), (1006, "the same of these five words", "en"),
    (1007, "THE same of  these five\nwords", None), (1008, "ab", "xx"), (1009, "naïve café 日本語 😀 ▁ x  y  ", None),
    (1010, "<|endoftext|> <s> special </s>", None), (None, "a text without a number", "en"), (None, None, None),
    (1011, "x\x00y \x1f   　 z", "en"),
]


@pytest.fixture(scope="session")
def rows(spark):
    """Documents of the smallest table and odd ones, as plain tuples of id, text and language."""
    given = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    return [*given, *ODD]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with columns whose names the operators use themselves."""
    table = [(i, t, g, "src", len(t or ""), "extra", 7, "n") for i, t, g in rows]
    return spark.createDataFrame(table, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
