"""ERA5 deliveries (A9, A10): ZIP archives of CSV, one grid point's series in each.

Spark lists the archives; a task opens each on the shared store and reads its
members as a stream, in chunks, so its memory does not grow with the archive.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ERA5_PRESET_COLUMNS
from ..session import ship_package

# Variables requested per preset, as named by the delivery service.
ERA5_PRESETS = {
    "solar": [
        "surface_solar_radiation_downwards",
        "total_sky_direct_solar_radiation_at_surface",
        "2m_temperature",
        "total_cloud_cover",
    ],
    "wind": [
        "100m_u_component_of_wind",
        "100m_v_component_of_wind",
        "10m_u_component_of_wind",
        "10m_v_component_of_wind",
        "surface_pressure",
        "2m_temperature",
        "10m_wind_gust_since_previous_post_processing",
    ],
}


def archive_name(lat: float, lon: float, preset: str, year: int | None = None) -> str:
    base = f"era5_lat{lat}_lon{lon}_{preset}"
    return base if year is None else f"{base}_{year}"


def _schema(preset: str) -> str:
    cols = ERA5_PRESET_COLUMNS[preset]
    return ", ".join(f"{c} {'timestamp_ntz' if c == 'valid_time' else 'double'}" for c in cols)


CHUNK_ROWS = 100_000


def _open(uri: str):
    """A seekable stream over a file of a store that pyarrow can open: parts of it are read when asked for."""
    from pyarrow import fs  # noqa: PLC0415
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    filesystem, path = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(path)


def csv_chunks(stream, cols: list[str], chunk_rows: int = CHUNK_ROWS) -> Iterator[pd.DataFrame]:
    """Rows of every CSV member of a ZIP archive, a bounded chunk at a time; members
    are inflated as they are read, so neither archive nor CSV is ever whole in memory."""
    with zipfile.ZipFile(stream) as z:
        for member in (n for n in z.namelist() if n.endswith(".csv")):
            with z.open(member) as f:
                for data in pd.read_csv(f, float_precision="round_trip", chunksize=chunk_rows, usecols=cols):
                    data["valid_time"] = pd.to_datetime(data["valid_time"])
                    yield data.astype({c: "float64" for c in cols if c != "valid_time"})[cols]


def read_archives(spark: SparkSession, glob: str, preset: str = "solar", streamed: bool = True) -> DataFrame:
    """ZIP archives -> typed rows of the preset, plus the archive's entity name.

    Spark lists the files and deals them out; the task of an archive opens it on the
    shared store and reads its CSV in chunks of ``CHUNK_ROWS``. ``streamed=False`` is
    for stores that only Spark can open: it passes the archive's bytes through Spark,
    one archive at a time in a task's memory.
    """
    cols = ERA5_PRESET_COLUMNS[preset]

    def unpack(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with (_open(path) if streamed else io.BytesIO(content)) as stream:
                    for data in csv_chunks(stream, cols):
                        yield data.assign(entity=path.rsplit("/", 1)[-1].removesuffix(".zip"))

    ship_package(spark)
    files = spark.read.format("binaryFile").load(glob)
    if streamed:    # the content is not read by the scan; a few names of files make no large partition
        slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
        files = files.select("path").repartition(slots, "path").withColumn("content", F.lit(None).cast("binary"))
    return files.select("path", "content").mapInPandas(unpack, _schema(preset) + ", entity string")


def stamp(df: DataFrame, batch_ts: str) -> DataFrame:
    """Landing stamp: one ``_extracted_at`` per delivered batch."""
    return df.withColumn("_extracted_at", F.lit(batch_ts).cast("timestamp_ntz"))
