"""Tables on storage: partitioned + clustered writes (A14-A16), scans that
must carry a time predicate (A13), the source registry (A19) and the
one-day row count (A18)."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RAW
from ..session import path_exists, qualified

# Rows per output file; keeps files well sized when one day is much larger than others.
MAX_RECORDS_PER_FILE = 5_000_000


def _same(df: DataFrame) -> DataFrame:
    return df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                cluster_by: Sequence[str] = (), mode: str = "overwrite",
                max_records_per_file: int = MAX_RECORDS_PER_FILE,
                replace_days_only: bool = False, watch=_same, dealt: bool = False) -> None:
    """Write Parquet, optionally partitioned by ``partition_by`` and clustered by
    ``cluster_by``: the files of a partition hold disjoint ranges of the clustering
    columns and each is sorted by them, so that a filter on them skips files and
    row groups by their min/max.

    Clustered tables are dealt out by ranges of (partition, clustering columns);
    a hash of the row comes last, so that one key with very many rows is split as
    well. The ranges come from a sample, for which Spark runs the stage before the
    shuffle once more (a narrow one: a shuffle of the input is not run again).
    Without clustering, the REBALANCE hint shuffles by the partition columns and
    adaptive execution splits a hot day over several tasks, with no sample; ``dealt``
    says that the rows lie by these columns already (read from a table in the same
    folders, or shuffled so before they were widened): no shuffle.

    An overwrite replaces the whole table, whatever the session's conf says;
    with ``replace_days_only`` it replaces the partitions present in ``df`` and
    leaves the others (a run over a window of days). ``watch`` wraps the frame
    in the writing stage itself (row checks counted on the way).
    """
    keys = list(partition_by) + list(cluster_by)
    out = df
    if cluster_by:
        spread = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t])
        out = out.repartitionByRange(*[F.col(k) for k in keys], spread)
    elif partition_by and not dealt:
        out = out.hint("rebalance", *partition_by)
    if keys:
        out = out.sortWithinPartitions(*keys)
    w = watch(out).write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if replace_days_only else "static")
    w.parquet(path)


def _table_name(path: str) -> str:
    """A name of the session's catalog for the table at a path."""
    return "vatio_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:24]


def _create(spark: SparkSession, name: str, schema: StructType, path: str, partition_by: Sequence[str],
            buckets: tuple[int, Sequence[str]] | None = None) -> None:
    """A catalog entry over Parquet files that are (or will be) at ``path``; its partitions are looked up anew."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)}) " if partition_by else ""
    if buckets:
        by = ", ".join(f"`{c}`" for c in buckets[1])
        part += f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets[0]} BUCKETS "
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {part}LOCATION '{qualified(spark, path)}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


_DYNAMIC = threading.Lock()
_INSIDE: list[str] = []


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """An insert into a catalog table takes the overwrite mode from the session only. The
    other writers here name theirs, so concurrent ones are not affected; the last to
    leave restores the session's."""
    key = "spark.sql.sources.partitionOverwriteMode"
    with _DYNAMIC:
        _INSIDE.append(spark.conf.get(key) if not _INSIDE else _INSIDE[0])
        spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        with _DYNAMIC:
            before = _INSIDE.pop()
            if not _INSIDE:
                spark.conf.set(key, before)


def write_bucketed(df: DataFrame, path: str, buckets: tuple[int, Sequence[str]], partition_by: str,
                   replace_days_only: bool = False, watch=_same) -> None:
    """Write Parquet in folders by ``partition_by`` and, within them, in buckets by
    the hash of some columns, each sorted by them. A join of two such tables on
    these columns reads them bucket by bucket and shuffles nothing.

    The rows are dealt out by the bucket columns first, so a task writes whole
    buckets (a file for each day and bucket, not for each task as well).
    """
    spark, (count, by) = df.sparkSession, buckets
    columns = [c for c in df.columns if c != partition_by] + [partition_by]
    name = _table_name(path)
    if not replace_days_only or not path_exists(spark, path):
        # Another layout or older rows may be there: an empty table replaces them.
        (df.select(columns).limit(0).write.mode("overwrite").partitionBy(partition_by)
         .option("partitionOverwriteMode", "static").parquet(path))
    _create(spark, name, df.select(columns).schema, path, [partition_by], buckets)
    out = df.select(columns).repartition(count, *by).sortWithinPartitions(partition_by, *by)
    with _dynamic_overwrite(spark):     # the folders of the frame's days; else all were emptied above
        watch(out).write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)


def bucketed_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_bucketed`` wrote, with its buckets."""
    return spark.table(_table_name(path))


class MissingTimeFilter(ValueError):
    pass


def scan_day_partitioned(spark: SparkSession, path: str, time_column: str,
                         start: str | None, end: str | None,
                         partition_column: str = "fecha_part", open_start: bool = False) -> DataFrame:
    """Read a day-partitioned table for [start, end) only.

    Refuses an unbounded scan; ``start`` may be open where ``end`` bounds it
    (``open_start``: everything up to the run clock). The predicate is put on the partition column
    (directory pruning) and on the time column (row-group skipping).
    """
    if not end or not (start or open_start):
        raise MissingTimeFilter(f"a time range is required to scan {path}")
    df = spark.read.parquet(path)
    e = F.lit(end).cast("timestamp_ntz")
    last_day = F.to_date(e - F.expr("INTERVAL 1 MICROSECOND"))   # end is exclusive
    df = df.filter((F.col(partition_column) <= last_day) & (F.col(time_column) < e))
    if start:
        s = F.lit(start).cast("timestamp_ntz")
        df = df.filter((F.col(partition_column) >= F.to_date(s)) & (F.col(time_column) >= s))
    return df


@dataclass(frozen=True)
class Source:
    name: str
    schema: StructType
    landing_glob: str          # relative to {root}/{source}/{date}/
    landing_source: str
    mode: str                  # append | overwrite
    partition_column: str | None = None
    time_column: str | None = None
    cluster_by: tuple[str, ...] = ()


# The raw sources, their landing file patterns and load modes.
SOURCES: dict[str, Source] = {
    "generacion_real": Source("generacion_real", RAW["generacion_real"], "generacion-real*",
                              "cen", "append", "fecha_part", "fecha_hora",
                              ("id_central", "tipo_tecnologia", "id_propietario")),
    "centrales_info": Source("centrales_info", RAW["centrales_info"], "centrales_v4*", "cen", "overwrite",
                             cluster_by=("id_central", "tipo_central")),
    "era5_solar": Source("era5_solar", RAW["era5_solar"], "era5_*_solar*", "era5", "append",
                         "fecha_part", "valid_time"),
    "era5_wind": Source("era5_wind", RAW["era5_wind"], "era5_*_wind*", "era5", "append",
                        "fecha_part", "valid_time"),
}


def rows_for_day(df: DataFrame, time_column: str, day: str) -> DataFrame:
    """One-row frame: rows whose ``time_column`` falls on ``day``."""
    return df.filter(F.to_date(F.col(time_column)) == F.lit(day).cast("date")) \
        .agg(F.count(F.lit(1)).alias("total_rows"))


def extraction_slice(df: DataFrame, time_column: str, start: str, end: str, **equals) -> DataFrame:
    """A parameterised slice of landed or raw data: [start, end] by day on
    ``time_column`` plus equality filters (e.g. ``id_central=42``)."""
    d = F.to_date(F.col(time_column))
    out = df.filter((d >= F.lit(start).cast("date")) & (d <= F.lit(end).cast("date")))
    for col, value in equals.items():
        out = out.filter(F.col(col) == F.lit(value))
    return out


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Expose models to SQL users as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)


def register_tables(spark: SparkSession, tables: Mapping[str, tuple[str, Sequence[str]]], schema: str,
                    prefix: str = "") -> None:
    """Expose written models (name -> path, partition columns) as tables of a schema of
    the session's catalog, created if absent: entries over the files as they lie, with
    their partitions and clustering; nothing is copied."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    for name, (path, partition_by) in tables.items():
        files = spark.read.parquet(path).schema
        columns = [f for f in files.fields if f.name not in partition_by] \
            + [f for f in files.fields if f.name in partition_by]
        _create(spark, f"`{schema}`.`{prefix + name}`", StructType(columns), path, partition_by)


def day_scan(spark: SparkSession, path: str, time_column: str, day: str) -> DataFrame:
    """The rows of one day of a day-partitioned table: its folder only."""
    end = (date.fromisoformat(day) + timedelta(days=1)).isoformat()
    return scan_day_partitioned(spark, path, time_column, f"{day} 00:00:00", f"{end} 00:00:00")
