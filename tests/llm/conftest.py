import pytest

from reelgauge.llm.shared import reachable


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    reachable(spark)


LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))

#: Nulls, empty and long texts, ties and repeated rows, and columns whose names the operators use themselves.
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, row long, fp long, id string, unit long, first string"
ODD_ROWS = [
    (3, "the cat sat on the mat and saw the dog run away", "en", "a", 1, 1, 1, "x", 1, "f"),
    (3, "the cat sat on the mat and saw the dog run away", "en", "a", 1, 1, 1, "x", 1, "f"),
    (1, "the cat sat on the mat and saw the dog run away", "en", "b", 1, 1, 1, "x", 1, "f"),
    (None, "le chat et la souris sont dans la maison avec nous", "fr", None, None, None, None, None, None, None),
    (4, None, None, None, None, None, None, None, None, None),
    (5, "", "fr", "b", 0, 1, 1, "x", 1, "f"),
    (6, " \n\t\n ", None, "b", 0, 1, 1, "x", 1, "f"),
    (7, LONG, "en", "a", 0, 1, 1, "x", 1, "f"),
    (8, "le chat noir\nune ligne assez longue pour compter\nune ligne assez longue pour compter", "fr", "c", 0, 1, 1, "x", 1, "f"),
    (9, "12 34 !!", "de", "a", 0, 1, 1, "x", 1, "f"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA).coalesce(2)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
