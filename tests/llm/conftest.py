import pytest
from pyspark.sql import Row

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Column names that operators use inside, to show that extra columns do not disturb them.
CLASHING = ["size", "score", "hits", "component", "rows", "word", "key", "n", "target", "copies", "found", "statistics"]


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet")


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and white texts, a very long one, ties and repeated rows."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, long, "en", "a", len(long)),
        (5, "one two three four five six seven", "en", "b", 33), (5, "one two three four five six seven", "en", "b", 33),
        (None, "ONE two\tthree four five six SEVEN", "en", "b", 33), (6, "one two three four five six seven", None, None, None),
        (7, "kurz", "de", "c", 4), (8, "ſtraße K été 日本語 token: \"abcDEF123\"", "de", "c", 20),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture
def extra(odd_documents):
    """The odd documents with further columns of clashing names."""
    from pyspark.sql import functions as F

    return odd_documents.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


def same_rows(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


__all__ = ["Row", "same_rows"]
