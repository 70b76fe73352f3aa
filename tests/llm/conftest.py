import pytest


@pytest.fixture(scope="module")
def docs(spark):
    """Few documents with nulls, empty texts, ties, repeated rows and clashing extra columns."""
    rows = [
        (1, "the cat of the house and the dog of the house sat in the sun for a day", "a"),
        (2, "the cat of the house and the dog of the house sat in the sun for a day", "b"),
        (3, "", "a"),
        (4, None, None),
        (None, "a text without an id of its own and of some length to be read here", "b"),
        (5, "short text", "a"),
        (5, "short text", "a"),
        (6, "word " * 3000, "c"),
        (7, "eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf " * 2, "c"),
        (8, "one line\none line\none line\nanother line of the text\n\n one line", "b"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return frame.selectExpr(
        "*", "'x' AS score", "1 AS size", "2 AS words", "3 AS node", "'y' AS row", "4 AS length"
    )


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (3, 0, 0), (6, 0, 1), (6, 0, 1), (8, None, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
