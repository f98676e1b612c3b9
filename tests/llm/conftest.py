import pytest

HARD = [
    # doc_id, text, extra: nulls, empty and long texts, repeated rows, ties
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "a"),
    (2, None, "b"),
    (3, "", None),
    (4, "   \n\t ", "c"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today.", "d"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today.", "d"),
    (None, "no id here, mail me at a.b@c.example.org", "e"),
    (7, "word " * 30_000, "f"),
    (8, "x" * 50_000, "g"),
    (9, "ÀÉ ça ß İ 漢字 🙂 <|endoftext|> it's 10.0.0.1", "h"),
]


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Awkward documents with an extra column of a clashing name (``th``)."""
    return spark.createDataFrame(HARD, "doc_id long, text string, th string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, th string")
