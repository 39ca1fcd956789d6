import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rank long, row long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing names."""
    long_text = " ".join(f"w{i % 977}" for i in range(30_000))
    base = "the quick brown fox jumps over the lazy dog and then runs far away from here"
    rows = [
        (1, base, "en", "a", 10, 1, 1, 1),
        (2, base, "en", "a", 10, 1, 1, 1),
        (2, base, "en", "a", 10, 1, 1, 1),
        (3, None, "de", None, None, 1, 1, 1),
        (4, "", "de", "b", 0, 1, 1, 1),
        (5, " \t\n", None, "b", 3, 1, 1, 1),
        (6, long_text, "fr", "c", 1, 1, 1, 1),
        (None, None, None, None, None, None, None, None),
        (None, "idiot one two three", "en", "a", 5, None, None, None),
        (8, "Ünïcode ΑΒΓ \x0b x", "el", "c", 7, 1, 1, 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
