import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = "Word soup of the long kind. " * 4000


@pytest.fixture()
def odd(spark):
    """Documents with every awkward case, and extra columns whose names operators use inside."""
    rows = [
        (1, "The MIT License, and token = 'abc123def456' in it; one two three four five six seven eight nine ten.", "en", "b", 3.0, "x"),
        (2, None, "en", "b", 3.0, "x"),
        (3, "", None, None, 3.0, None),
        (4, LONG, "en", "a", 3.0, "x"),
        (5, LONG, "en", "a", 3.0, "x"),
        (5, LONG, "en", "a", 3.0, "x"),                     # a repeated row
        (None, "ein zwei drei vier und noch ein Wort über Äpfel", "de", "b", 3.0, "x"),
        (7, " \t\n ", "de", "b", 3.0, "x"),
        (8, "\U0001F600 \U00010400bc 漢字 mixed", None, "b", 3.0, "x"),
        (9, "two words", "de", "c", 3.0, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n double, row string")


@pytest.fixture()
def labels(spark):
    rows = [(1, 1, 0), (4, 1, 0), (5, 0, 1), (9, 1, None), (99, 0, 1), (None, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture()
def benchmark(spark):
    rows = [(10, "One two three four five, six seven eight nine ten!"), (11, "mixed"), (11, "mixed"), (12, ""), (13, None), (None, "words")]
    return spark.createDataFrame(rows, "item_id bigint, text string")
