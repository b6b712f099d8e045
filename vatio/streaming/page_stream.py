"""Completeness of page series while their pages arrive (A8), as keyed stream state.

Pages land in any order, in several files, over any number of micro-batches. The
state of a series (a landing folder) is the set of its pages with their number of
rows and declared total: one small entry a page, whatever the pages hold. A page
that is delivered again with the same facts is the same entry. From the set follow
the audit's columns, the numbers of the missing pages and a status.

Each micro-batch writes the verdicts of the series that it touched;
``latest_audit`` reads the newest of each series. Batches replayed after a crash
replace their own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import path_exists
from ..sources.landing import landed_pages, series_of


def series_verdicts(pages: DataFrame, page_size: int) -> DataFrame:
    """One row for each series of ``pages`` (file, page, declared_total, page_rows; one row
    a page), a stream or a table. Pages without a number are told apart by their file.

    status: ``complete``; ``missing`` if numbered pages up to the expected number have not
    come; ``short`` if all came but rows are wanting or a page before the last is not full;
    ``open`` as long as nothing is declared."""
    entry = F.struct("page", F.when(F.col("page").isNull(), F.col("file")).alias("file"),
                     F.col("page_rows").cast("bigint").alias("n"), F.col("declared_total").alias("t"))
    seen = (pages.withColumn("series", series_of("file")).groupBy("series")
            .agg(F.collect_set(entry).alias("seen")).withColumn("seen", F.array_sort("seen")))
    n = F.size("seen")
    total = F.array_max(F.transform("seen", lambda p: p["t"]))
    full = F.forall(F.slice("seen", F.lit(1), F.greatest(n - 1, F.lit(0))), lambda p: p["n"] >= page_size)
    numbers = F.transform(F.filter("seen", lambda p: p["page"].isNotNull()), lambda p: p["page"])
    out = seen.select(
        "series", n.cast("bigint").alias("pages"),
        F.aggregate("seen", F.lit(0).cast("bigint"), lambda a, p: a + p["n"]).alias("rows"),
        total.alias("declared_total"),
        F.ceil(total / F.lit(page_size)).cast("bigint").alias("expected_pages"),
        F.size(F.filter("seen", lambda p: p["n"] < page_size)).cast("bigint").alias("short_pages"),
        F.size(F.filter("seen", lambda p: p["n"] == 0)).cast("bigint").alias("empty_pages"),
        full.alias("__full"), numbers.alias("__numbers"))
    wanted = F.when(F.col("expected_pages") > 0, F.sequence(F.lit(1).cast("bigint"), F.col("expected_pages"))) \
        .otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("missing", F.when(F.size("__numbers") > 0, F.array_except(wanted, "__numbers")))
    out = out.withColumn("complete", (F.col("rows") == F.col("declared_total"))
                         & (F.col("pages") == F.col("expected_pages")) & F.col("__full"))
    status = (F.when(F.col("declared_total").isNull(), F.lit("open")).when(F.col("complete"), F.lit("complete"))
              .when(F.size("missing") > 0, F.lit("missing")).otherwise(F.lit("short")))
    return out.withColumn("status", status).drop("__full", "__numbers")


def stream_audit(spark: SparkSession, glob: str, row_schema: T.StructType, page_size: int, out: str,
                 checkpoint: str, results_key: str | None = "data", available_now: bool = True,
                 max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Audit page files as they land under ``glob`` (a file is one page, over any lines, or a
    page a line). The verdicts of a micro-batch are written to ``out/batch=N``."""
    stream = (spark.readStream.format("text").option("wholetext", True)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(glob))
    verdicts = series_verdicts(landed_pages(stream, row_schema, results_key), page_size)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    writer = verdicts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def files_per_trigger(spark: SparkSession, folder: str, batches: int = 8, least: int = 8) -> int:
    """Page files for each micro-batch so that what lies in ``folder`` is taken in ``batches``
    of them, however many files there are (a micro-batch costs seconds of its own); ``least``
    for small folders."""
    files = spark.read.format("binaryFile").load(folder).select("path").count()
    return max(least, -(-files // batches))


def latest_audit(spark: SparkSession, out: str) -> DataFrame | None:
    """The newest verdict of each series, None before the first batch."""
    if not path_exists(spark, out):
        return None
    rows = spark.read.parquet(out)
    facts = [c for c in rows.columns if c not in ("series", "batch")]
    return (rows.groupBy("series").agg(F.max_by(F.struct(*facts), "batch").alias("v"))
            .select("series", *[F.col(f"v.{c}").alias(c) for c in facts]))
