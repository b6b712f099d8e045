"""Landed JSONL -> raw table, incrementally (the append loads A1, A3, A4).

A file-source stream over every landing date picks up each new file once
(the checkpoint records what was read), normalises instants to UTC and
appends each micro-batch with the batch loader's own write, so that batch and
stream loads may share a table: one layout, one clustering, no sink log that
would hide the other's files. ``availableNow`` processes what has landed and
stops; the same query with a processing-time trigger runs continuously.

A micro-batch is appended once: a mark beside the checkpoint is set before its
append and another after it. A batch that is replayed after a crash in between
appends only the rows that the table does not hold yet.

Late and repeated records need no stream state: the raw table keeps every
version and staging keeps the latest per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import LANDING
from ..session import path_exists
from ..sources.catalog import SOURCES, write_table
from ..sources.landing import typed_landing


def stream_landing(spark: SparkSession, root: str, table: str, table_path: str,
                   checkpoint: str, available_now: bool = True,
                   max_files_per_trigger: int = 1000) -> StreamingQuery:
    src = SOURCES[table]
    if src.mode != "append":
        raise ValueError(f"{table} is replaced on each load, not appended")
    glob = f"{root.rstrip('/')}/{src.landing_source}/*/{src.landing_glob}"
    stream = (spark.readStream.schema(LANDING[table]).option("maxFilesPerTrigger", max_files_per_trigger)
              .option("mode", "FAILFAST").json(glob))
    rows = typed_landing(stream, table).withColumn(src.partition_column, F.to_date(F.col(src.time_column)))
    marks = f"{checkpoint.rstrip('/')}-batches"

    def append(batch: DataFrame, number: int) -> None:
        append_once(batch, f"{marks}/{number}", table_path, src)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(append)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def append_once(batch: DataFrame, mark: str, table_path: str, src) -> None:
    """Append a batch unless ``mark`` says that it was; after a crash between
    the append and the mark, append what is missing."""
    spark = batch.sparkSession
    if path_exists(spark, f"{mark}/done"):
        return
    todo = batch
    if path_exists(spark, f"{mark}/begun") and path_exists(spark, table_path):
        days = batch.select(F.col(src.partition_column).alias("__day")).distinct()
        held = spark.read.schema(batch.schema).parquet(table_path)
        held = held.join(F.broadcast(days), held[src.partition_column].eqNullSafe(F.col("__day")), "left_semi")
        todo = batch.exceptAll(held.select(*batch.columns))
    spark.range(1).write.mode("overwrite").json(f"{mark}/begun")
    write_table(todo, table_path, partition_by=[src.partition_column], cluster_by=src.cluster_by, mode="append")
    spark.range(1).write.mode("overwrite").json(f"{mark}/done")
