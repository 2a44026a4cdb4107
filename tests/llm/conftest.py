import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `Score` string, `a.b` int, kept string"
ODD = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away from all of the other dogs there", "en", "s"),
    (1, "the quick brown fox jumps over the lazy dog and runs far away from all of the other dogs there", "en", "s"),
    (2, None, "en", "s"),
    (3, "", None, None),
    (None, " \t\n ", "en", None),
    (4, "¡señor! ▁ 日本語 \U0001f600 \u0000 password=abcdefgh12345 +1 (555) 123-4567", "es", "s"),
    (5, "word " * 60_000, None, "s"),
    (6, "x" * 200_000, "en", "t"),
    (None, None, None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in all columns, empty and long texts, repeated rows, clashing column names."""
    rows = [(*row, len(row[1]) if row[1] else None, "old", 7, "old") for row in ODD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where(F.lit(False))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
