"""Intermediate models M4-M8."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.energy import (classify_source, direct_fraction, fraction_to_pct,
                                kelvin_to_celsius, per_hour_energy_to_power,
                                precision_category)
from ..functions.geo import grid_snap, haversine_m, with_utm_latlon, wkt_point
from ..functions.numeric import round_half_away, safe_divide
from ..functions.time import cyclic, dt_part
from ..operators.dedup import latest_per_key
from ..operators.fill import forward_fill
from ..operators.joins import join_dimension

PLANTS_GEO_OUT = ["id_central", "nombre_central", "state_central", "region", "comuna", "provincia",
                  "tipo_tecnologia", "coordenada_este_utm", "coordenada_norte_utm", "zona_huso",
                  "latitude", "longitude", "geo_point", "_extracted_at", "_loaded_at"]


def plants_geo(stg_plants: DataFrame) -> DataFrame:
    """M4: newest *located* version of each plant, with latitude/longitude.

    Rows without coordinates are dropped before choosing the newest version,
    so an older located version wins over a newer one without coordinates.
    """
    located = stg_plants.dropna(subset=["coordenada_este_utm", "coordenada_norte_utm", "zona_huso"])
    # Project every located version, then keep the newest: the aggregate also
    # stops inferred filters on latitude/longitude from being pushed (inlined)
    # into the projection arithmetic.
    projected = with_utm_latlon(located, "coordenada_este_utm", "coordenada_norte_utm",
                                "zona_huso", out="__c")
    with_coords = latest_per_key(projected, ["id_central"], ["_extracted_at"])
    return with_coords.select(
        *PLANTS_GEO_OUT[:10],
        F.col("__c.latitude").alias("latitude"),
        F.col("__c.longitude").alias("longitude"),
        wkt_point(F.col("__c.longitude"), F.col("__c.latitude")).alias("geo_point"),
        "_extracted_at", "_loaded_at",
    )


def era5_cells(plants: DataFrame) -> DataFrame:
    """M5: each normal, located plant -> nearest 0.25 deg cell, distance, category."""
    src = plants.filter((F.col("state_central") == "normal")
                        & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    snapped = src.select(
        "id_central", "nombre_central", "tipo_tecnologia",
        classify_source("tipo_tecnologia").alias("clasificacion_fuente"),
        "region", "latitude", "longitude",
        grid_snap("latitude").alias("lat_era5"), grid_snap("longitude").alias("lon_era5"))
    dist = haversine_m("latitude", "longitude", "lat_era5", "lon_era5")
    return snapped.select(
        "id_central", "nombre_central", "tipo_tecnologia", "clasificacion_fuente", "region",
        F.col("latitude").alias("lat_real"), F.col("longitude").alias("lon_real"),
        "lat_era5", "lon_era5",
        round_half_away(F.abs(F.col("latitude") - F.col("lat_era5")), 4).alias("diferencia_lat_grados"),
        round_half_away(F.abs(F.col("longitude") - F.col("lon_era5")), 4).alias("diferencia_lon_grados"),
        round_half_away(dist, 2).alias("distancia_era5_metros"),
        precision_category(dist).alias("categoria_precision"),
    )


def era5_features(stg_solar: DataFrame) -> DataFrame:
    """M6: weather features per (UTC hour, cell)."""
    ts = F.col("valid_time")
    hour, month = dt_part("hour", ts), dt_part("month", ts)
    return stg_solar.select(
        ts.alias("timestamp_utc"),
        F.col("latitude").alias("lat_era5"), F.col("longitude").alias("lon_era5"),
        kelvin_to_celsius("t2m").alias("temperatura_celsius"),
        per_hour_energy_to_power("ssrd").alias("ghi_wm2"),
        per_hour_energy_to_power("fdir").alias("dni_wm2"),
        fraction_to_pct("tcc").alias("nubosidad_pct"),
        direct_fraction("fdir", "ssrd").alias("fraccion_directa"),
        cyclic(hour, 24, "cos").alias("hora_cos"), cyclic(hour, 24, "sin").alias("hora_sin"),
        cyclic(month, 12, "cos").alias("mes_cos"), cyclic(month, 12, "sin").alias("mes_sin"),
        hour.alias("hora_utc"), month.alias("mes"),
    )


ENRICHED_OUT = ["id_central", "nombre_central", "tipo_tecnologia", "clasificacion_fuente",
                "state_central", "region", "comuna", "provincia", "latitude", "longitude",
                "geo_point", "generacion_real_mw", "potencia_maxima_mw", "factor_planta",
                "timestamp_local", "timestamp_utc", "fecha", "hora", "dia_semana", "mes", "anio",
                "_extracted_at", "_loaded_at"]


def generation_enriched(stg_gen: DataFrame, plants: DataFrame, plants_small: bool | None = None) -> DataFrame:
    """M7: hourly generation joined to its plant (all states).

    ``tipo_tecnologia`` is the generation row's own; the renewable class comes
    from the registry's technology. Plants without coordinates drop out.
    """
    dim = plants.select(
        "id_central", "nombre_central",
        classify_source("tipo_tecnologia").alias("clasificacion_fuente"),
        "state_central", "region", "comuna", "provincia", "latitude", "longitude", "geo_point")
    joined = join_dimension(stg_gen, dim, "id_central", small=plants_small)
    ts = F.col("timestamp_local")
    return joined.select(
        "id_central", "nombre_central", "tipo_tecnologia", "clasificacion_fuente",
        "state_central", "region", "comuna", "provincia", "latitude", "longitude", "geo_point",
        "generacion_real_mw", "potencia_maxima_mw",
        round_half_away(safe_divide("generacion_real_mw", "potencia_maxima_mw"), 6).alias("factor_planta"),
        "timestamp_local", "timestamp_utc",
        F.to_date(ts).alias("fecha"),
        dt_part("hour", ts).alias("hora"), dt_part("dayofweek", ts).alias("dia_semana"),
        dt_part("month", ts).alias("mes"), dt_part("year", ts).alias("anio"),
        "_extracted_at", "_loaded_at",
    )


SOLAR_TARGET_OUT = ["id_central", "timestamp_utc", "fecha", "lat_era5", "lon_era5",
                    "generacion_real_mw", "potencia_maxima_mw", "factor_planta"]


def solar_target(enriched: DataFrame, cells: DataFrame, forward_fill_capacity: bool = False,
                 min_generation: float | None = None, cells_small: bool | None = None) -> DataFrame:
    """M8: solar hours with their weather cell.

    The inner join to the cell lookup also keeps only normal plants.
    Options from the model documentation, off by default as in its SQL:
    ``forward_fill_capacity`` (last non-NULL capacity per plant over time;
    the plant factor is then recomputed from it) and ``min_generation``.
    """
    src = enriched.filter(F.col("tipo_tecnologia") == "Solar")
    if min_generation is not None:
        src = src.filter(F.col("generacion_real_mw") >= F.lit(float(min_generation)))
    lookup = cells.select("id_central", "lat_era5", "lon_era5")
    out = join_dimension(src, lookup, "id_central", small=cells_small).select(*SOLAR_TARGET_OUT)
    if forward_fill_capacity:
        out = forward_fill(out, "id_central", "timestamp_utc", ["potencia_maxima_mw"])
        out = out.withColumn("factor_planta", round_half_away(
            safe_divide("generacion_real_mw", "potencia_maxima_mw"), 6))
    return out
