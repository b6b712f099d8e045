"""A training-data pipeline over ``documents``: quality classifier, SimHash
near-dedup, benchmark decontamination, mixing to target weights, sharding.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns the documents that its operator leaves, and each result is written and
reread as the next stage's ``docs``. All but the last stage keep the columns of
``documents``; the last adds ``shard``. The mix repeats documents: a source
whose target is above its size is read up to twice, so a document may have two
equal rows from there on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vatio.llm import decontaminate, mixing, quality_classifier, sharding, simhash_dedup
from vatio.llm.common import read, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.remove_leaks(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources reads it."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, 0 to 15."""
    return sharding.assign_shards(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminated),
          ("mix", mix_sources), ("shard", shard)]

#: The classifier and the fingerprints' hash are not SQL: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
