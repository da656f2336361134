import random

import pytest

LETTERS = "ab cde fghij klm nopq rs tuv wxyz".split()


def sentence(seed, words):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(LETTERS, k=draw.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    long = sentence(1, 6000)
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n ", "en", None),
        (None, "Some text of no id at all", "en", "a"),
        (None, None, None, None),
        (5, long, "en", "b"),
        (6, long, "en", "b"),
        (6, long, "en", "b"),
        (7, long.upper(), None, None),
        (8, "x", "en", "b"),
        (9, "X", "en", "b"),
        (10, "é É 1234 🙂 token: secret99", "fr", "c"),
        (11, sentence(2, 60), "en", "c"),
        (12, sentence(2, 60) + " end", "en", "c"),
        (14, sentence(3, 300), "en", "c"),
        (15, sentence(2, 60), "en", "c"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = ("row", "norm", "salt", "key", "kept", "keep_id", "path", "size", "rank", "score", "piece", "place", "head")
    for name in names:
        frame = frame.selectExpr("*", f"'clash' AS {name}")
    return frame


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
