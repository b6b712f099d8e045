"""Stand-ins for what the remote services deliver, made from the driver's tables:
page envelopes and weather archives. They only shape rows; reading them is the
library's work (``landing``, ``era5``)."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ERA5_PRESET_COLUMNS
from ..session import qualified, scratch_path, ship_package
from .era5 import archive_name

IDS_PER_PAGE = 40_000  # a page holds the rows of so many operation ids: bounded, no global position


def write_pages(rows: DataFrame, id_col: str = "id_opreal", pages_per_file: int = 0) -> str:
    """Page envelopes of the rows, one page to a line and one for each range of ids, in gzip; the folder."""
    path = scratch_path(rows.sparkSession, "pages")
    total = rows.agg(F.count("*").alias("totalCount")).withColumn("one", F.lit(1))
    pages = rows.groupBy((F.floor(F.col(id_col) / IDS_PER_PAGE) + 1).alias("page")).agg(
        F.collect_list(F.struct(*rows.columns)).alias("data")).withColumn("one", F.lit(1))
    envelopes = pages.join(F.broadcast(total), "one").drop("one")  # one row
    envelopes.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite") \
        .option("maxRecordsPerFile", pages_per_file).option("compression", "gzip").text(path)
    return path


def _put(uri: str, content: bytes) -> None:
    """Write a file whole or not at all: to a name of its own that no reader's
    glob takes, then renamed. A retried or speculative task replaces it by the
    same content."""
    from pyarrow import fs  # noqa: PLC0415
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    filesystem, path = fs.FileSystem.from_uri(uri)
    parent, name = path.rsplit("/", 1)
    filesystem.create_dir(parent, recursive=True)
    temporary = f"{parent}/_{name}-{uuid.uuid4().hex}"
    with filesystem.open_output_stream(temporary) as out:
        out.write(content)
    filesystem.move(temporary, path)


def write_archives(df: DataFrame, root: str, preset: str = "solar") -> DataFrame:
    """Write one ZIP (one CSV inside) per grid point and year under ``root``
    (a year of hours bounds each group); returns (path, rows) per archive."""
    cols = ERA5_PRESET_COLUMNS[preset]
    # As Spark resolves the path: on a cluster a path without scheme is on its default store.
    base = qualified(df.sparkSession, root).rstrip("/")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        year = int(pdf["__year"].iloc[0])
        pdf = pdf[cols].sort_values("valid_time")
        lat, lon = float(pdf["latitude"].iloc[0]), float(pdf["longitude"].iloc[0])
        name = archive_name(lat, lon, preset, year)
        csv = pdf.to_csv(index=False, date_format="%Y-%m-%d %H:%M:%S")
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"{name}.csv", csv)
        uri = f"{base}/{name}.zip"
        _put(uri, buf.getvalue())
        return pd.DataFrame({"path": [uri], "rows": [len(pdf)]})

    ship_package(df.sparkSession)
    keyed = df.select(*cols, F.year("valid_time").alias("__year"))
    return keyed.groupBy("latitude", "longitude", "__year").applyInPandas(one, "path string, rows bigint")
