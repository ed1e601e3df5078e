import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, columns whose names clash with internal ones."""
    a, b = " ".join(WORDS[:120]), " ".join(WORDS[100:300])
    near = " ".join(WORDS[:118] + ["x", "y"])
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (2, a, "en", "s", 2), (3, near, "en", None, 3), (4, b, None, "s", None),
            (None, b, "en", "s", 5), (None, None, None, None, None), (5, None, "en", "s", 6), (6, "", "en", "s", 7),
            (7, " \n\t ", "en", "s", 8), (8, "one word", "en", "s", 9), (9, " ".join(WORDS * 60), "en", "s", 10),
            (10, "same " * 300, "en", "s", 11), (11, "é日本\U0001F600 " * 90, "de", "s", 12)]
    rows = [(*r, i, "c", [i], 0, 1) for i, r in enumerate(rows)]
    names = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()),
             ("_h", T.IntegerType()), ("row", T.StringType()), ("spans", T.ArrayType(T.IntegerType())), ("toxic", T.IntegerType()),
             ("kept", T.IntegerType())]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, t) for n, t in names]))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
