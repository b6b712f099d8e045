"""Staging models M1-M3: typed, cleaned, latest version of each record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import decimal_comma, leading_int, state_tag, strip_tags
from ..functions.time import LOCAL_TZ, with_local_hour_utc
from ..operators.dedup import latest_per_key
from ._clock import clock

GENERATION_OUT = ["id_central", "tipo_tecnologia", "generacion_real_mw", "potencia_maxima_mw",
                  "timestamp_local", "timestamp_utc", "_extracted_at", "_loaded_at"]


def stg_generation(raw: DataFrame, as_of=None, loaded_at=None, tz: str = LOCAL_TZ,
                   tiebreak: str = "id_opreal") -> DataFrame:
    """M1: hourly generation per plant, UTC hour, latest extraction wins.

    ``as_of`` reproduces the operational filter ``fecha_hora < now`` (it also
    drops NULL and future hours). Ties on ``_extracted_at`` (one stamp per
    landed page) go to the greatest ``tiebreak``, then to the greatest
    (tipo_tecnologia, generacion_real_mw, potencia_maxima_mw, timestamp_local),
    so exact re-deliveries resolve the same way every run.
    """
    src = raw.filter(F.col("fecha_hora") < clock(as_of))
    src = with_local_hour_utc(src, "fecha_hora", "hora", "__utc", tz)
    typed = src.select(
        F.col("id_central").try_cast("bigint").alias("id_central"),
        F.col("tipo_tecnologia").cast("string").alias("tipo_tecnologia"),
        decimal_comma("gen_real_mw").alias("generacion_real_mw"),
        decimal_comma("potencia_maxima").alias("potencia_maxima_mw"),
        F.col("fecha_hora").alias("timestamp_local"),
        F.col("__utc").alias("timestamp_utc"),
        "_extracted_at",
        F.col(tiebreak).alias("__tiebreak"),
    )
    latest = latest_per_key(typed, ["id_central", "timestamp_utc"],
                            ["_extracted_at", "__tiebreak", "tipo_tecnologia", "generacion_real_mw",
                             "potencia_maxima_mw", "timestamp_local"])
    return latest.select(*GENERATION_OUT[:-1], clock(loaded_at).alias("_loaded_at"))


PLANTS_OUT = ["id_central", "nombre_central", "state_central", "region", "comuna", "provincia",
              "tipo_tecnologia", "coordenada_este_utm", "coordenada_norte_utm", "zona_huso",
              "_extracted_at", "_loaded_at"]


def stg_plants(raw: DataFrame, loaded_at=None) -> DataFrame:
    """M2: plant registry with cleaned name, status tag and numeric UTM fields.

    No deduplication here (versions are resolved in plants_geo).
    """
    return raw.select(
        F.col("id_central").try_cast("bigint").alias("id_central"),
        strip_tags("central").alias("nombre_central"),
        state_tag("central").alias("state_central"),
        "region", "comuna", "provincia", "tipo_tecnologia",
        decimal_comma("coordenada_este").alias("coordenada_este_utm"),
        decimal_comma("coordenada_norte").alias("coordenada_norte_utm"),
        leading_int("zona_huso").alias("zona_huso"),
        "_extracted_at",
        clock(loaded_at).alias("_loaded_at"),
    )


ERA5_OUT = ["valid_time", "latitude", "longitude", "t2m", "ssrd", "tcc", "fdir",
            "_extracted_at", "_loaded_at"]


def stg_era5_solar(raw: DataFrame, loaded_at=None) -> DataFrame:
    """M3: ERA5 solar variables as landed, plus the load stamp."""
    return raw.select(*ERA5_OUT[:-1], clock(loaded_at).alias("_loaded_at"))
