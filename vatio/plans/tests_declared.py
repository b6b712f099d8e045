"""The declared data tests of the models (the test inventory, by model)."""

from __future__ import annotations

from ..operators.quality import Check

_HOURS = list(range(24))
_MONTHS = list(range(1, 13))
_CLASSES = ["Renovable", "Convencional"]

# The singular bounding-box test (degrees).
BBOX = {"lat": "latitude", "lon": "longitude", "lat_min": -65.0, "lat_max": -15.0,
        "lon_min": -120.0, "lon_max": -60.0}


def _nn(i, m, c, **kw):
    return Check(i, m, "not_null", c, **kw)


def _un(i, m, c):
    return Check(i, m, "unique", c)


def _av(i, m, c, values):
    return Check(i, m, "accepted_values", c, {"values": values})


def _uc(i, m, cols):
    return Check(i, m, "unique_combination", None, {"columns": cols})


_WARN100 = {"severity": "warn", "error_if": ">100"}

CHECKS: list[Check] = [
    _un(1, "plants_geo", "id_central"), _nn(2, "plants_geo", "id_central"),
    _nn(3, "plants_geo", "nombre_central"),
    _un(4, "era5_cells", "id_central"), _nn(5, "era5_cells", "id_central"),
    _nn(6, "era5_cells", "lat_era5"), _nn(7, "era5_cells", "lon_era5"),
    _nn(8, "era5_cells", "categoria_precision"),
    _av(9, "era5_cells", "categoria_precision", ["Perfecta", "Excelente", "Buena", "Regular", "Mala"]),
    _nn(10, "era5_features", "timestamp_utc"), _nn(11, "era5_features", "lat_era5"),
    _nn(12, "era5_features", "lon_era5"),
    _uc(13, "era5_features", ["timestamp_utc", "lat_era5", "lon_era5"]),
    _nn(14, "generation_enriched", "id_central"), _nn(15, "generation_enriched", "nombre_central"),
    _av(16, "generation_enriched", "clasificacion_fuente", _CLASSES),
    _nn(17, "generation_enriched", "generacion_real_mw"),
    _nn(18, "generation_enriched", "timestamp_local"), _nn(19, "generation_enriched", "fecha"),
    _nn(20, "solar_target", "id_central"),
    Check(21, "solar_target", "relationships", "id_central", {"to": "plants_geo", "field": "id_central"}),
    _nn(22, "solar_target", "timestamp_utc"), _nn(23, "solar_target", "fecha"),
    _nn(24, "solar_target", "lat_era5"), _nn(25, "solar_target", "lon_era5"),
    _nn(26, "solar_target", "generacion_real_mw"),
    _nn(27, "solar_target", "potencia_maxima_mw", severity="warn"),
    _uc(28, "solar_target", ["id_central", "timestamp_utc"]),
    _nn(29, "fact_hourly", "region"),
    Check(30, "fact_hourly", "accepted_range", "factor_planta", {"min": 0, "max": 1}),
    _nn(31, "fact_hourly", "timestamp_utc"), _nn(32, "fact_hourly", "hora"),
    _av(33, "fact_hourly", "hora", _HOURS), _nn(34, "fact_hourly", "mes"),
    _av(35, "fact_hourly", "mes", _MONTHS), _nn(36, "fact_hourly", "anio"),
    _uc(37, "fact_hourly", ["id_central", "timestamp_utc"]),
    _un(38, "plant_efficiency", "id_central"), _nn(39, "plant_efficiency", "id_central"),
    _nn(40, "plant_efficiency", "nombre_central"),
    _av(41, "plant_efficiency", "clasificacion_fuente", _CLASSES),
    _nn(42, "plant_efficiency", "dias_con_datos"), _nn(43, "plant_efficiency", "generacion_total_mwh"),
    _nn(44, "daily_by_technology", "fecha"), _nn(45, "daily_by_technology", "tipo_tecnologia"),
    _nn(46, "daily_by_technology", "clasificacion_fuente"),
    _av(47, "daily_by_technology", "clasificacion_fuente", _CLASSES),
    _nn(48, "daily_by_technology", "generacion_total_mwh"),
    _nn(49, "daily_by_plant", "fecha"), _nn(50, "daily_by_plant", "id_central"),
    _nn(51, "daily_by_plant", "nombre_central"),
    _av(52, "daily_by_plant", "clasificacion_fuente", _CLASSES),
    _nn(53, "daily_by_plant", "generacion_total_mwh"),
    _uc(54, "daily_by_plant", ["fecha", "id_central"]),
    _un(55, "system_summary", "fecha"), _nn(56, "system_summary", "fecha"),
    _nn(57, "system_summary", "generacion_total_mwh"), _nn(58, "system_summary", "top_tecnologia"),
    _nn(59, "training_solar", "id_central"), _nn(60, "training_solar", "timestamp_utc"),
    _nn(61, "training_solar", "fecha"), _nn(62, "training_solar", "lat_era5"),
    _nn(63, "training_solar", "lon_era5"), _nn(64, "training_solar", "factor_planta"),
    _uc(65, "training_solar", ["id_central", "timestamp_utc"]),
    _nn(66, "stg_plants", "id_central"), _un(67, "stg_plants", "id_central"),
    _av(68, "stg_plants", "state_central", ["en_revision", "no_mostrar", "normal"]),
    _nn(69, "stg_plants", "coordenada_este_utm", **_WARN100),
    _nn(70, "stg_plants", "coordenada_norte_utm", **_WARN100),
    _nn(71, "stg_plants", "zona_huso", **_WARN100),
    _nn(72, "stg_generation", "id_central"),
    Check(73, "stg_generation", "relationships", "id_central", {"to": "stg_plants", "field": "id_central"}),
    _nn(74, "stg_generation", "timestamp_utc"), _nn(75, "stg_generation", "generacion_real_mw"),
    _uc(76, "stg_generation", ["id_central", "timestamp_utc"]),
    _nn(77, "stg_era5_solar", "valid_time"), _nn(78, "stg_era5_solar", "latitude"),
    _nn(79, "stg_era5_solar", "longitude"), _nn(80, "stg_era5_solar", "_extracted_at"),
    _nn(81, "stg_era5_solar", "_loaded_at"),
    Check(82, "plants_geo", "bbox", "latitude, longitude", BBOX, severity="warn"),
]

KIND_GROUPS = {
    "dq_not_null": ("not_null",), "dq_unique": ("unique",),
    "dq_accepted_values": ("accepted_values",), "dq_relationships": ("relationships",),
    "dq_unique_combination": ("unique_combination",), "dq_range": ("accepted_range",),
    "dq_bbox": ("bbox",),
}
