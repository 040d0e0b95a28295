import pytest

from tillgrain.llm.common import prepare

LONG = " ".join(f"word{i % 977}x{i}" for i in range(9000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and then it sleeps for a while\nsecond line", "en", 7),
    (2, "the quick brown fox jumps over the lazy dog and then it sleeps for a while\nsecond line", None, None),
    (3, None, "en", 1), (4, "", "de", 0), (5, "  \n\t ", None, 5), (6, LONG, "en", 9), (7, LONG + " end", "en", 9),
    (8, "one", "fr", 1), (9, "a" * 350, None, 1), (9, "b" * 120 + "é" * 60, "fr", 2),
    (10, "dieser Satz steht hier, damit es auch etwas Deutsches gibt: über Äpfel", "de", 3),
    (10, "dieser Satz steht hier, damit es auch etwas Deutsches gibt: über Äpfel", "de", 3),
    (None, "nobody knows this row, +1 (705) 555-6638 or x.y@example.com", "en", 4),
    (None, None, None, None),
]


@pytest.fixture()
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and a column that clashes."""
    prepare(spark)
    return spark.createDataFrame([(*r, "x") for r in ROWS],
                                 "doc_id long, text string, lang string, score long, chunk string")


@pytest.fixture()
def nothing(docs):
    return docs.limit(0)
