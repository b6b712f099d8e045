"""Raw tables for SQL users that refuse a scan without a day.

``register_guarded`` makes a day-partitioned table known under a name. Its scan is
planned by a data source that is handed the query's filters: bounds on the day or
the time column choose the day folders, a scan with none of them fails. Other
comparisons skip row groups by their statistics, and Spark applies every filter
again, so a bound can only leave out folders that hold no row of the result.

Meant for interactive SQL. It reads all columns of the chosen row groups through
Arrow; the models read the same files by ``scan_day_partitioned``, which holds
them to a bound as well and lets Spark prune columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)
from pyspark.sql.types import DateType, StructField, StructType, TimestampNTZType

from ..session import qualified, ship_package
from .catalog import SOURCES, MissingTimeFilter

FORMAT = "vatio_day_table"
#: Rows of a batch that a task holds.
BATCH_ROWS = 65_536
_COMPARED = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _day(value) -> date:
    return value.date() if isinstance(value, datetime) else value


class DayFile(InputPartition):
    def __init__(self, path: str, day: date | None):
        super().__init__(None)
        self.path, self.day = path, day


class DayTable(DataSource):
    """Options: ``path``, ``day`` (partition column) and ``time`` (the column it is the day of)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: StructType) -> DayTableReader:
        return DayTableReader(self.options, schema)


class DayTableReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path, self.day, self.time = options["path"], options["day"], options["time"]
        self.schema = schema
        self.first: date | None = None
        self.last: date | None = None
        self.bounded = False
        self.compared: list[tuple[str, str, object]] = []

    def _within(self, first: date | None, last: date | None) -> None:
        self.bounded = True
        if first is not None:
            self.first = first if self.first is None else max(self.first, first)
        if last is not None:
            self.last = last if self.last is None else min(self.last, last)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802 - the interface's name
        for f in filters:
            kind, column = type(f), f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            on_day = column in (self.day, self.time)
            if on_day and kind is In and f.value and None not in f.value:
                self._within(min(map(_day, f.value)), max(map(_day, f.value)))
            elif on_day and kind in _COMPARED and f.value is not None:
                day = _day(f.value)
                self._within(None if kind in (LessThan, LessThanOrEqual) else day,
                             None if kind in (GreaterThan, GreaterThanOrEqual) else day)
            if kind in _COMPARED and column is not None and column != self.day and f.value is not None:
                self.compared.append((column, _COMPARED[kind], f.value))
            yield f      # Spark applies it again

    def partitions(self) -> list[DayFile]:
        if not self.bounded:
            raise MissingTimeFilter(f"a filter on {self.day} or {self.time} is required to scan {self.path}")
        from pyarrow import fs  # noqa: PLC0415
        filesystem, root = _filesystem(self.path)
        out = []
        for folder in filesystem.get_file_info(fs.FileSelector(root)):
            name, _, value = folder.base_name.partition("=")
            if name != self.day or folder.type != fs.FileType.Directory:
                continue
            try:
                day = date.fromisoformat(unquote(value))
            except ValueError:      # rows without a day are in no bound
                continue
            if (self.first is None or day >= self.first) and (self.last is None or day <= self.last):
                out += [DayFile(f.path, day) for f in filesystem.get_file_info(fs.FileSelector(folder.path))
                        if f.base_name.endswith(".parquet") and f.size]
        return out

    def read(self, partition: DayFile) -> Iterator:
        import pyarrow as pa  # noqa: PLC0415
        import pyarrow.dataset as ds  # noqa: PLC0415
        from pyspark.sql.pandas.types import to_arrow_schema  # noqa: PLC0415
        if partition is None or not getattr(partition, "path", None):
            return
        filesystem, _ = _filesystem(self.path)
        files = ds.dataset(partition.path, format="parquet", filesystem=filesystem)
        keep = None
        for column, sign, value in self.compared:
            if column not in files.schema.names:
                continue
            left, right = ds.field(column), pa.scalar(value)
            one = {"==": left == right, ">": left > right, ">=": left >= right, "<": left < right, "<=": left <= right}[sign]
            keep = one if keep is None else keep & one
        target = to_arrow_schema(self.schema)
        columns = [f.name for f in self.schema.fields if f.name in files.schema.names]
        for batch in files.to_batches(columns=columns, filter=keep, batch_size=BATCH_ROWS):
            arrays = []
            for f in target:
                if f.name == self.day:
                    arrays.append(pa.array([partition.day] * batch.num_rows, f.type))
                elif f.name in columns:
                    arrays.append(batch.column(f.name).cast(f.type))
                else:
                    arrays.append(pa.nulls(batch.num_rows, f.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=target)


def _filesystem(uri: str):
    from pyarrow import fs  # noqa: PLC0415
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def register_guarded(spark: SparkSession, root: str, table: str, view: str | None = None) -> DataFrame:
    """Make the stored raw table ``root/table`` known to SQL as ``view`` (default: the table's name)."""
    src = SOURCES[table]
    if src.partition_column is None:
        raise ValueError(f"{table} is not partitioned by day")
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DayTable)
    schema = StructType([StructField(f.name, f.dataType) for f in src.schema.fields]
                        + [StructField(src.partition_column, DateType())])
    assert isinstance(schema[src.time_column].dataType, TimestampNTZType)
    df = (spark.read.format(FORMAT).schema(schema).option("path", qualified(spark, f"{root.rstrip('/')}/{table}"))
          .option("day", src.partition_column).option("time", src.time_column).load())
    df.createOrReplaceTempView(view or table)
    return df
