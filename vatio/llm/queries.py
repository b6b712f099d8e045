"""Registered queries of this folder: name -> builder, and DuckDB SQL where SQL
can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, embedding_dedup, lexical_search, line_dedup, mixing, quality_classifier,
               quality_rules, secret_scan, sharding, simhash_dedup, spelling, token_counts, toxicity)
from .common import held_out, read
from .oracle import ORACLE  # noqa: F401 - part of the interface

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_counts(read(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents").select("doc_id", "text"),
                               read(spark, sf_dir, "benchmark"))


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    def of(kind: str) -> Column:
        return F.filter("secrets", lambda s: s["kind"] == kind)

    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(secret_scan.joined(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(F.col("secrets")).alias("spans"))


@_query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_counts(docs).select("doc_id", "source", "size", "source_size", "target",
                                          (F.col("size") * F.col("times")).alias("taken"))


@_query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, read(spark, sf_dir, "labels"))
    spans = F.array_join(F.transform("toxicity.spans", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "toxicity.score",
                         (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         spans.alias("spans"))


@_query
def op6_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select(
        "doc_id", (F.octet_length(_text()) + 1).cast("bigint").alias("size"),
        F.crc32(_text().cast("binary")).alias("text_crc32"))
    # Ranges of slots are cut by what the slots are ordered by: texts that share an id are spread as well.
    rows = rows.withColumn("digest", F.md5(F.concat_ws(":", sharding.key_text(F.col("doc_id")), F.col("size").cast("string"),
                                                       F.col("text_crc32").cast("string")).cast("binary")))
    placed = sharding.assign_shards(rows, "doc_id", (1.0,) * 16, "shard", "grown_shard")
    return sharding.number_slots(placed, "shard", "digest", ["doc_id", "size", "text_crc32", "grown_shard"]) \
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@_query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_classifier.classify(docs, read(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(read(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_dedup.near_duplicates(docs)


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


@_query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                 read(spark, sf_dir, "benchmark"))


@_query
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling.group_variants(words)
