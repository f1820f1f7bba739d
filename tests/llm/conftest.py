"""A small table with every awkward case, for all operators."""

import pytest

LONG = " ".join(f"w{i % 977} x{i % 13}" for i in range(60_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows, and columns with clashing names."""
    rows = [
        (1, None, None, "a"),
        (2, "", "en", None),
        (3, " \n\t ", "en", "a"),
        (None, "some words of a text without an id stand here", None, None),
        (None, None, None, None),
        (4, LONG, "en", "a"),
        (5, "one two three four five six seven eight nine ten", "en", "a"),
        (5, "one two three four five six seven eight nine ten", "en", "a"),
        (6, "one two three four five six seven eight nine ten", "de", "b"),
        (7, "ONE two three four five six seven eight nine ten", None, "b"),
        (8, "only three words", "en", "b"),
        (9, "Only three words", "en", "b"),
        (10, "!!! ??? 123", "en", "b"),
        (11, "é́ İ ſK 日本語 <|endoftext|> \x1c a\x85b", "fr", "b"),
    ]
    clashing = "score double, spans string, kept boolean, length int, piece int, _row int, _nth int, _keep int, _found int, _leaked int, band int, n int, words int, h int, s int, p int"
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    extra = [f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in clashing.split(", ")]
    return docs.selectExpr("doc_id", "text", "lang", "source", "length(text) AS n_chars", *extra).cache()


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("false")
