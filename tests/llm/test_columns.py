"""No column, row or match of the caller is lost: clashing names, repeated rows,
null ids, several texts of one id, windows of few different shingles."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vatio.llm import decontaminate, line_dedup, mixing, quality_classifier, simhash_dedup

NAMES = ["size", "times", "target", "source_size", "doc_key1", "doc_key2", "__k1", "__k2", "__score", "__i", "c0", "key"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("source", T.StringType()), *[T.StructField(n, T.StringType()) for n in NAMES]])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i % 7 else None, f"words of text number {i} and some more of them here", "ab"[i % 2],
             *[f"{n}-{i}" for n in NAMES]) for i in range(60)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_stages_keep_the_columns_of_the_caller(spark, docs):
    given = Counter(tuple(r) for r in docs.collect())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert set(tuple(r) for r in mixed.collect()) <= set(given)
    item = [(0, docs.filter("doc_id = 5").first()["text"])]
    benchmark = spark.createDataFrame(item, "item_id long, text string")
    left = decontaminate.remove_leaks(docs, benchmark)
    assert left.columns == docs.columns
    assert Counter(tuple(r) for r in left.collect()) == Counter({k: v for k, v in given.items() if k[0] != 5})
    one = simhash_dedup.keep_one(docs)
    assert one.columns == docs.columns and set(tuple(r) for r in one.collect()) <= set(given)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    good = quality_classifier.keep_good(docs, labels, threshold=0.0)
    assert good.columns == docs.columns and Counter(tuple(r) for r in good.collect()) == given


def test_remove_repeats_loses_no_whole_text(spark):
    a, b = "first line of a text with words", "another line of it that is quite different"
    rows = [(5, f"{a}\n{b}"), (5, f"{a}\n{b}"), (6, f"{a}\n\nfresh words only here"), (None, f"one two three\n{b}"),
            (None, "null id and its own line"), (7, "zwei Zeilen\neine davon"), (7, f"ganz anders\n{a}"), (8, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit("m")).repartition(3)
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.remove_repeats(df).collect())
    assert got == Counter([(5, f"{a}\n{b}"), (5, ""), (6, "\nfresh words only here"), (None, "one two three"),
                           (None, "null id and its own line"), (7, "zwei Zeilen\neine davon"), (7, "ganz anders"),
                           (8, None), (9, "")])
    other = df.withColumn("mark", F.monotonically_increasing_id())       # rows that differ elsewhere
    texts = Counter(r["text"] for r in line_dedup.remove_repeats(other).filter("doc_id = 5").collect())
    assert texts == Counter([f"{a}\n{b}", ""])


def test_windows_of_few_shingles_are_found(spark):
    item = " ".join(["go", "stop"] * 14 + ["go"])
    text = " ".join(["stop", "go"] * 14 + ["stop"])
    found = decontaminate.leaks(spark.createDataFrame([(1, text), (2, "go on")], "doc_id long, text string"),
                                spark.createDataFrame([(0, item)], "item_id long, text string")).collect()
    assert [(r["doc_id"], round(r["similarity"], 3)) for r in found] == [(1, 0.923)]
