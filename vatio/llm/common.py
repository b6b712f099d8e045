"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, ship_package

#: A word is a maximal run of characters other than space, tab, LF, VT, FF, CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Share of label rows kept out of every fit: crc32(doc_id as text) mod FOLDS = 0.
FOLDS = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder named by ``spark.checkpoint.dir`` and reread:
    cuts the lineage, and a lost executor costs a read of the table only."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_in(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no fit may see; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def row_key(df: DataFrame, seed: int = 0) -> Column:
    """64-bit hash of all columns of a row, nulls told apart from absent values.
    Rows with equal values in every column share the key."""
    cols: list[Column] = [F.lit(seed)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        has_map = "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString()
        cols += [F.to_json(F.struct(c.alias("v"))) if has_map else c, c.isNull()]
    return F.xxhash64(*cols)


def plain_names(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ...: no column of the caller can clash with
    one that an operator adds, and equal names are told apart. Row keys stay the same."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def plain(docs: DataFrame, column: str) -> str:
    """The name under :func:`plain_names` of a column of ``docs``."""
    return f"c{docs.columns.index(column)}"


def own_names(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names, from a frame that has them under plain ones."""
    return df.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def ship(df: DataFrame) -> None:
    """Make this package importable in the Python workers."""
    ship_package(df.sparkSession)


def running_sum(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` (long) over all rows up to and
    including each one, in the order of the columns ``order``.

    Range partitioning, one running sum per partition, and the offsets of the
    partitions (one row each) joined back; no task sees more than a partition.
    The order should be total: tied rows get their sums in any order.
    """
    ship(df)
    schema = T.StructType([*df.schema.fields, T.StructField("__part", T.IntegerType()),
                           T.StructField("__run", T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext  # noqa: PLC0415
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            sums = total + np.cumsum(b[value].to_numpy(dtype=np.int64))
            if len(sums):
                total = int(sums[-1])
            yield b.assign(__part=np.int32(part), __run=sums)

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    local = written(ranged.mapInPandas(run, schema), f"running-{out}")
    by_part = local.groupBy("__part").agg(F.sum(value).alias("__sum"))
    from pyspark.sql import Window  # noqa: PLC0415
    # One row per partition of the range sort.
    before = by_part.select("__part", (F.sum("__sum").over(Window.orderBy("__part")) - F.col("__sum"))
                            .alias("__before"))
    return (local.join(F.broadcast(before), "__part")
            .withColumn(out, F.col("__run") + F.col("__before")).drop("__part", "__run", "__before"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long), root being the
    smallest node of its component.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): each
    round is two groupings with map-side minima and two joins on the edges;
    the edge tables are written, so a round never recomputes an earlier one.
    """
    def tidy(e: DataFrame) -> DataFrame:
        return (e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .filter("a < b").distinct())

    def print_of(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    e = written(tidy(edges), "edges")
    seen = print_of(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        e = written(tidy(both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b")
                         .unionByName(low.select(F.col("m").alias("a"), F.col("a").alias("b")))), "edges")
        low = e.groupBy("b").agg(F.min("a").alias("m"))
        e = written(tidy(e.join(low, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
                         .unionByName(low.select(F.col("m").alias("a"), "b"))), "edges")
        now = print_of(e)
        if now == seen:
            break
        seen = now
    # Stars remain: every edge goes from a root to a node of its component.
    return (e.select(F.col("b").alias("node"), F.col("a").alias("root"))
            .unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()))
