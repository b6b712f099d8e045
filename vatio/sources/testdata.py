"""Adapter: driver testdata (TPC-H-like parquet) -> the four raw contracts.

Integer arithmetic only, so Spark and SQL engines derive identical rows.
The registry gets a second, later version for plants with id % 5 = 0: for
id % 10 = 5 it is tagged under review, for id % 10 = 0 it lost its easting,
so latest-located selection (E2) has something to choose.
"""

from __future__ import annotations

from functools import cached_property
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import session_key
from ..schemas import ERA5_SOLAR, ERA5_WIND, GENERATION, PLANTS

# ---- Fixed values -----------------------------------------------------------
# Technology by code (key % 8); code 7 has no technology.
TECHNOLOGY_BY_CODE = (
    "Solar",
    "Eolica",
    "Térmica",
    "Hidráulica de Embalse",
    "Solar",
    "Mini Hidráulica de Pasada",
    "Biomasa",
    None,
)
REGISTRY_STAMP = "2026-01-01 00:00:00"
REGISTRY_V2_STAMP = "2026-01-02 00:00:00"
GENERATION_STAMP_BASE = "2026-01-01 00:00:00"
GENERATION_DAY_BLOCKS = (("2024-04-01", 13), ("2024-09-01", 12))  # start, days
ERA5_WINDOWS = (("2024-04-01", 14), ("2024-09-01", 14))            # start, days
ERA5_STAMP = "2026-01-01 00:00:00"
# -----------------------------------------------------------------------------

EPOCH = datetime(1970, 1, 1)


def epoch_hour(day: str) -> int:
    return int((datetime.fromisoformat(day) - EPOCH) / timedelta(hours=1))


def era5_hour_ranges() -> list[tuple[int, int]]:
    """Inclusive epoch-hour ranges of the weather windows."""
    return [(epoch_hour(d), epoch_hour(d) + 24 * n - 1) for d, n in ERA5_WINDOWS]


class RawTables:
    """The four raw tables, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def generacion_real(self) -> DataFrame:
        return raw_generacion(self.spark, self.sf_dir)

    @cached_property
    def centrales_info(self) -> DataFrame:
        return raw_centrales(self.spark, self.sf_dir)

    @cached_property
    def _cells(self) -> DataFrame:
        from ..plans import intermediate, staging  # noqa: PLC0415 - cells come from the plant models
        return intermediate.era5_cells(intermediate.plants_geo(staging.stg_plants(self.centrales_info)))

    @cached_property
    def era5_solar(self) -> DataFrame:
        return raw_era5_solar(self._cells)

    @cached_property
    def era5_wind(self) -> DataFrame:
        return raw_era5_wind(self._cells)


def _tech(code: Column) -> Column:
    expr = None
    for i, name in enumerate(TECHNOLOGY_BY_CODE):
        val = F.lit(name).cast("string")
        expr = F.when(code == i, val) if expr is None else expr.when(code == i, val)
    return expr


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _conform(df: DataFrame, schema) -> DataFrame:
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


_READERS: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table reader; the (read-only) inputs are listed once per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (session_key(spark), path)
    if key[0] is None:
        return spark.read.parquet(path)
    if key not in _READERS:
        _READERS[key] = spark.read.parquet(path)
    return _READERS[key]


def raw_centrales(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation and region have fixed sizes (25 and 5 rows) at every scale factor.
    geo = F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    k = F.col("s_suppkey")
    versions = F.when(k % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    base = s.join(geo, s.s_nationkey == geo.n_nationkey).withColumn("__v", F.explode(versions))
    v2 = F.col("__v") == 2
    tag = (F.when(k % 10 == 3, F.lit(" [EN_REVISION]"))
           .when(k % 10 == 7, F.lit(" [NO_MOSTRAR]"))
           .when(v2 & (k % 10 == 5), F.lit(" [EN_REVISION]"))
           .otherwise(F.lit("")))
    easting = (F.when(k % 17 == 16, F.lit("Sin información"))
               .otherwise(F.concat((F.lit(250000) + (k * 7919) % 450000).cast("string"), F.lit(",5"))))
    easting = F.when((k % 23 == 22) & (k % 17 != 16), F.concat(easting, F.lit("d"))).otherwise(easting)
    easting = F.when(v2 & (k % 10 == 0), F.lit(None).cast("string")).otherwise(easting)
    out = base.select(
        k.alias("id_central"),
        # Tabs and no-break spaces around some names.
        F.concat(F.when(k % 11 == 5, F.lit("\t\u00a0")).otherwise(F.lit("")), F.col("s_name"),
                 F.when(k % 11 == 6, F.lit("\u00a0 ")).otherwise(F.lit("")), tag).alias("central"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("provincia"),
        F.col("n_name").alias("comuna"),
        _tech(k % 8).alias("tipo_tecnologia"),
        easting.alias("coordenada_este"),
        F.concat((F.lit(5000000) + (k * 104729) % 2900000).cast("string"), F.lit(",25"))
        .alias("coordenada_norte"),
        F.when(k % 19 == 18, F.lit("sin huso")).when(k % 3 == 0, F.lit("18H"))
        .otherwise(F.lit("19G")).alias("zona_huso"),
        F.when(v2, _ts(REGISTRY_V2_STAMP)).otherwise(_ts(REGISTRY_STAMP)).alias("_extracted_at"),
    )
    return _conform(out, PLANTS)


def raw_generacion(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    d = p % 25
    (start1, n1), (start2, _) = GENERATION_DAY_BLOCKS
    day = F.when(d < n1, F.date_add(F.lit(start1).cast("date"), d.cast("int"))) \
        .otherwise(F.date_add(F.lit(start2).cast("date"), (d - n1).cast("int")))
    hora = o % 24 + 1
    code = F.when(p % 31 == 0, (s + 3) % 8).otherwise(s % 8)
    pot = (F.when(p % 97 == 0, F.lit(""))
           .when(p % 89 == 0, F.lit("0"))
           .when(p % 83 == 0, F.lit("50f"))
           .otherwise(F.concat((F.lit(50) + s % 7).cast("string"), F.lit(",5"))))
    out = li.select(
        (o * 10 + F.col("l_linenumber")).alias("id_opreal"),
        F.concat(o.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("llave_opreal"),
        s.alias("id_central"),
        F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_quantity")).alias("gen_real_mw"),
        F.timestamp_add("HOUR", hora - 1, day.cast("timestamp_ntz")).alias("fecha_hora"),
        hora.alias("hora"),
        pot.alias("potencia_maxima"),
        _tech(code).alias("tipo_tecnologia"),
        F.timestamp_add("SECOND", o, _ts(GENERATION_STAMP_BASE)).alias("_extracted_at"),
    )
    return _conform(out, GENERATION)


def _hours(cells: DataFrame) -> DataFrame:
    """Every cell x every hour of the weather windows, generated per cell row."""
    seqs = [F.sequence(F.lit(a).cast("bigint"), F.lit(b).cast("bigint")) for a, b in era5_hour_ranges()]
    return cells.withColumn("__h", F.explode(F.concat(*seqs)))


def _valid_time(h: Column) -> Column:
    return F.timestamp_add("HOUR", h, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def raw_era5_solar(cells: DataFrame) -> DataFrame:
    """Solar variables on each distinct grid cell of the plant lookup."""
    h = F.col("__h")
    base = _hours(cells.select(F.col("lat_era5").alias("latitude"),
                               F.col("lon_era5").alias("longitude")).distinct())
    # Values differ between cells, so that a join to the wrong cell shows.
    cell = F.abs((F.col("latitude") * 4).cast("bigint") * 7 + (F.col("longitude") * 4).cast("bigint"))
    ssrd = F.when((h % 24 >= 11) & (h % 24 <= 22), (((h + cell) * 37) % 1000 + 1) * 3600).otherwise(0) \
        .cast("double")
    out = base.select(
        _valid_time(h).alias("valid_time"), "latitude", "longitude",
        (F.lit(273.15) + (h % 24 + cell % 8).cast("double") + F.lit(0.25)).alias("t2m"),
        ssrd.alias("ssrd"),
        (((h + cell) % 11).cast("double") / F.lit(10.0)).alias("tcc"),
        (ssrd * (h % 10).cast("double") / F.lit(10.0)).alias("fdir"),
        _ts(ERA5_STAMP).alias("_extracted_at"),
    )
    return _conform(out, ERA5_SOLAR)


def raw_era5_wind(cells: DataFrame) -> DataFrame:
    """Wind variables on the same keys (raw contract only; no model reads it)."""
    h = F.col("__h")
    base = _hours(cells.select(F.col("lat_era5").alias("latitude"),
                               F.col("lon_era5").alias("longitude")).distinct())
    out = base.select(
        _valid_time(h).alias("valid_time"), "latitude", "longitude",
        ((h % 13).cast("double") - F.lit(6.0)).alias("u100"),
        ((h % 11).cast("double") - F.lit(5.0)).alias("v100"),
        ((h % 9).cast("double") - F.lit(4.0)).alias("u10"),
        ((h % 7).cast("double") - F.lit(3.0)).alias("v10"),
        (F.lit(95000.0) + (h % 50).cast("double") * F.lit(10.0)).alias("sp"),
        (F.lit(273.15) + (h % 24).cast("double")).alias("t2m"),
        ((h % 17).cast("double")).alias("i10fg"),
        _ts(ERA5_STAMP).alias("_extracted_at"),
    )
    return _conform(out, ERA5_WIND)


_RAW: dict[tuple[str, str], RawTables] = {}


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The raw tables of a driver folder; the (lazy, immutable) plans are
    built once per session and folder, execution happens per query."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    if key[0] is None:
        return RawTables(spark, sf_dir)
    if key not in _RAW:
        _RAW[key] = RawTables(spark, sf_dir)
    return _RAW[key]


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Drop the plans kept for a folder: its files have changed and are listed anew."""
    key, folder = session_key(spark), sf_dir.rstrip("/")
    _RAW.pop((key, folder), None)
    for k in [k for k in _READERS if k[0] == key and k[1].rsplit("/", 1)[0] == folder]:
        _READERS.pop(k, None)
