"""Small tables with every awkward row."""

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and extra
    columns whose names operators might use themselves."""
    long = " ".join(f"w{k % 977}x" for k in range(200_000)) + "\n" + "a" * 50_000
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (4, "One two three four five six seven eight.\nsame line\nSAME line ", "en", "b", 60),
        (5, "One two three four five six seven eight.\nsame line\nSAME line ", "en", "b", 60),
        (5, "One two three four five six seven eight.\nsame line\nSAME line ", "en", "b", 60),
        (None, "no id here, but words", "fr", "c", 21),
        (7, long, "en", None, len(long)),
        (8, "zwei Wörter ñandú 漢字 \U0001f600 it's", "de", "c", 30),
        ((1 << 53) + 1, "x", "en", "a", 1),
        (10, "mail me.now@host.example.com or +1 (555) 010-9999, 4111 1111 1111 1111, 10.0.0.256 10.0.0.1", None, "a", 90),
    ]
    names = ("fingerprint", "component_id", "key", "id", "size", "score", "part", "shard", "fp", "u", "v")
    return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(n).alias(n) for n in names])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
