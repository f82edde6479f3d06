"""Small tables with everything that whole tables may hold."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, at string, carry int, found string, row int, n long"


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank, short and long texts, exact and near copies, repeated rows and ids."""
    long = words(4000, 10_000)
    rows = [
        (1, words(60), "en", "a", 1),
        (2, words(60), "en", "b", 1),  # copy
        (3, words(58) + " x y", "en", None, 1),  # near copy
        (4, None, None, None, None),
        (5, "", "de", "a", 0),
        (6, " \t\n", "de", "a", 3),
        (7, "one two", "fr", "b", 7),
        (8, "ONE  two", "fr", "b", 8),
        (9, long, "en", "c", 1),
        (10, long[:9000] + " tail", "en", "c", 1),
        (11, "é" * 150 + words(30, 900), "es", "c", 1),
        (11, "é" * 150 + words(30, 900), "es", "c", 1),  # repeated row
        (12, words(60, 5), "en", "a", 1),
        (12, words(40, 700), "en", "a", 1),  # repeated id
        (None, words(60), "en", "a", 1),
        (None, None, "en", "a", 1),
        (13, "same same same same same same same same same same", "en", "a", 1),
        (14, words(60, 2000) + "\n" + words(60), "en", "a", 1),
    ]
    return [(*r, "clash", 1, "clash", 2, 3) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def real(spark):
    from pathlib import Path

    path = "/root/testdata/sf0.001"
    if not Path(path).exists():
        pytest.skip("no test data here")
    return path
