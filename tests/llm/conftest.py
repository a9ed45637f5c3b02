import pytest
from pyspark.sql import types as T

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
#: Nulls in any column, empty and very long texts, repeated rows, equal keys, and columns named like the operators' own.
EDGES = [
    (1, None, None, None), (None, "some words of a text without a key", "en", None), (2, "", "en", "s"), (3, " \n\t", None, "s"),
    (4, LONG, "en", "s"), (5, "same text here for two", "en", "s"), (6, "same text here for two", "en", "s"),
    (7, "repeated row", "de", "s"), (7, "repeated row", "de", "s"), (8, "one key", "en", "s"), (8, "but two texts", "en", "s"),
    (9, "Ünïcode wörds — „quoted“ Ünïcode wörds", "de", "s"), (10, "1234 5678 !!! ???", "fr", None),
]
NAMES = ["score", "label", "h", "rank", "length", "key", "text_hash", "doc", "rows", "_rank", "spans", "items", "weight", "size", "n", "features"]


@pytest.fixture(scope="session")
def edges(spark):
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), *[T.StructField(n, T.StringType()) for n in NAMES]])
    return spark.createDataFrame([(*row, *["x"] * len(NAMES)) for row in EDGES], schema).repartition(3)


@pytest.fixture(scope="session")
def no_rows(edges):
    return edges.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
