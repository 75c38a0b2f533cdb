"""Small tables with every awkward case, and brute-force helpers."""

import random

import pytest
from pyspark.sql import types as T

ROWS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("n_words", T.StringType()), T.StructField("row", T.IntegerType())])


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def make(spark, rows):
    """documents of (doc_id, text), with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, None, "x", k) for k, (i, t) in enumerate(rows)], ROWS)


def prose(seed, n, words=400):
    r = random.Random(seed)
    return " ".join(r.choice("abcdefgh") + r.choice("aeiou") + str(r.randrange(words)) for _ in range(n))


@pytest.fixture(scope="session")
def awkward():
    """Null and empty texts, blanks, null ids, repeated rows, ties, one very long text and odd characters."""
    long_text = prose(1, 30000) + "\n" + "7 " * 5000 + "a" * 20000
    return [(1, None), (2, ""), (3, " \t\n\x0b "), (None, "alone with no id"), (4, "same row"), (4, "same row"), (4, "other text of four"),
            (5, long_text), (6, "Ünï ▁çode 日本 𝄞 \x00 end\r\n\r\n"), (7, "\n\n\n"), (8, prose(2, 40)), (9, prose(2, 40)), (None, None)]
