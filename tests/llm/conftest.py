import pytest

from tidemark.session import ship_package

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, node bigint, row string, key binary"


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    ship_package(spark)


LONG = " ".join(f"w{i % 9973}x{i}" for i in range(60_000))
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))
NEAR = BASE.replace("alpha30", "other")
ROWS = [
    (1, None, "b"),
    (2, "", "b"),
    (3, " \n\t ", None),
    (4, "one", None),
    (5, LONG, "a"),
    (6, BASE, "a"),
    (7, BASE, "a"),
    (8, NEAR, "c"),
    (8, NEAR, "c"),
    (None, "a text without an id, written by nobody", "c"),
    (None, BASE, "a"),
    (9, "Mixed CASE words\nand a second line. Released under the MIT License.", "a"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 5, 6, "r", b"k") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows and columns with clashing names."""
    return frame(spark, ROWS)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
