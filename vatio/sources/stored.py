"""Raw tables read from storage (the production input, instead of the
testdata adapter): ``{root}/{table}`` Parquet tables as written by the loaders."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW
from .catalog import SOURCES, MissingTimeFilter, scan_day_partitioned


def whole_days(start: str, end: str) -> tuple[str, str]:
    """A window as two midnights; a window that cuts a day is refused, as its
    partitions would be replaced by parts of them."""
    a, b = datetime.fromisoformat(start), datetime.fromisoformat(end)
    if a.time() != datetime.min.time() or b.time() != datetime.min.time() or a >= b:
        raise ValueError(f"a window of whole days is required, not {start} to {end}")
    return a.isoformat(sep=" "), b.isoformat(sep=" ")


class StoredRawTables:
    """Day-partitioned tables are read through a time filter only: a window of
    whole days [start, end), or everything before the run clock ``as_of``.

    Weather is in UTC and plants report local days, so a window of weather is a
    day wider at both ends.
    """

    def __init__(self, spark: SparkSession, root: str, start: str | None = None, end: str | None = None,
                 as_of: str | None = None):
        if bool(start) != bool(end):
            raise MissingTimeFilter("a window needs both its start and its end")
        if not end and not as_of:
            raise MissingTimeFilter("a time window or a run clock is required to read the raw tables")
        self.spark, self.root, self.as_of = spark, root.rstrip("/"), as_of
        self.window = whole_days(start, end) if start and end else None

    def _read(self, name: str, around_days: int = 0) -> DataFrame:
        path, src = f"{self.root}/{name}", SOURCES[name]
        if src.partition_column is None:
            df = self.spark.read.parquet(path)
        elif self.window:
            pad = timedelta(days=around_days)
            a, b = (datetime.fromisoformat(x) for x in self.window)
            df = scan_day_partitioned(self.spark, path, src.time_column, (a - pad).isoformat(sep=" "),
                                      (b + pad).isoformat(sep=" "), src.partition_column)
        else:
            df = scan_day_partitioned(self.spark, path, src.time_column, None, self.as_of,
                                      src.partition_column, open_start=True)
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW[name].fields])

    @cached_property
    def generacion_real(self) -> DataFrame:
        return self._read("generacion_real")

    @cached_property
    def centrales_info(self) -> DataFrame:
        return self._read("centrales_info")

    @cached_property
    def era5_solar(self) -> DataFrame:
        return self._read("era5_solar", around_days=1)

    @cached_property
    def era5_wind(self) -> DataFrame:
        return self._read("era5_wind", around_days=1)
