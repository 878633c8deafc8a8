import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, start long, host string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a very long text, clashing extra columns."""
    long_text = " ".join(f"word{i % 977} of{i % 31}" for i in range(60_000))
    some = "The quick brown fox jumps over the lazy dog near the river bank while seven geese look on. " * 3
    rows = [
        (1, some, "en", "a", 1, 7, 7, "x"),
        (1, some, "en", "a", 1, 7, 7, "x"),
        (2, some.upper(), "en", None, None, 7, 7, "x"),
        (3, None, None, None, None, None, None, None),
        (4, "", "en", "b", 0, 7, 7, "x"),
        (5, " \t\n ", "de", "b", 4, 7, 7, "x"),
        (6, "1234 !!! ___", "de", "b", 4, 7, 7, "x"),
        (7, long_text, "en", "c", 9, 7, 7, "x"),
        (8, long_text + " more", "en", "c", 9, 7, 7, "x"),
        (None, some, "en", "a", 1, 7, 7, "x"),
        (9, "Straße über Köln ist schön und lang genug", "de", "c", 9, 7, 7, "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
