import pytest
from pyspark.sql import types as T

# Columns beside those of documents have the names that operators use or return.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("target", T.MapType(T.StringType(), T.LongType())), T.StructField("fp", T.StringType()),
])
LONG = " ".join(f"word{i * 7919 % 3001}" for i in range(20_000))
PLAIN = "the quick brown fox jumps over the lazy dog while nine more animals look on from afar"


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), "x", "y", "z", {"k": 1}, None)


ODD = [
    row(1, None), row(2, ""), row(3, " \t\n"), row(4, LONG), row(5, PLAIN), row(5, PLAIN), row(5, PLAIN),
    row(6, PLAIN, "de", "b"), row(None, PLAIN), row(None, None, None, None), row(7, "zwei Wörter", None, "b"),
    row(8, "ein ß und é\nund mehr\n\n", "de", None), row(9, PLAIN.upper(), "en", "c"), row(10, "a b", "en", "c"),
    row(11, PLAIN + "\n" + PLAIN, "en", "Z"), row(2**62, "far id", "en", "é"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 12)] + [(None, 1, 1), (5, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
