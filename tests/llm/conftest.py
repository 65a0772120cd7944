import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    words = ["thin", "or", "ing", "Re", "été", "naïve", "x1", "the", "of", "and"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, tail = text(80), text(60)
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "b", 1),
        (3, base + " " + tail, "fr", "a", None),
        (4, base + ".", None, None, 2),
        (5, "", "en", "a", 0),
        (6, None, "en", "c", 0),
        (7, " \t\n ", None, "b", 3),
        (8, text(30_000), "de", "a", 9),
        (9, "one two", "en", "b", 7),
        (10, "one two", "en", "b", 7),
        (11, tail.upper(), "en", "c", 7),
        (12, "été " * 40, "fr", None, 5),
        (12, "été " * 40, "fr", None, 5),
        (None, base, "en", "a", 1),
        (None, None, None, None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def no_labels(spark):
    kinds = [T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("quality", T.IntegerType()), ("toxic", T.IntegerType()))]
    return spark.createDataFrame([], T.StructType(kinds))
