"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes (spark, sf_dir) and returns a DataFrame computed from the
driver tables at ``sf_dir`` (through the raw-contract adapter).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .plans.pipeline import Models

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn
    return deco


def _model(attr: str) -> Builder:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Models.from_testdata(spark, sf_dir), attr)
    build.__name__ = attr
    return build


MODEL_QUERIES = {
    "stg_generation": ("stg_generation", "stg_generacion_real"),
    "stg_plants": ("stg_plants", "stg_centrales_info"),
    "stg_era5_solar": ("stg_era5_solar", "stg_solar_passed"),
    "plants_geo": ("plants_geo", "int_centrales_geo"),
    "era5_cells": ("era5_cells", "int_compatibilidad_era5"),
    "era5_features": ("era5_features", "int_era5_solar_features"),
    "generation_enriched": ("generation_enriched", "int_generacion_enriched"),
    "solar_target": ("solar_target", "int_solar_target"),
    "fact_hourly": ("fact_hourly", "fct_generacion_hora"),
    "daily_by_technology": ("daily_by_technology", "mart_generacion_diaria"),
    "daily_by_plant": ("daily_by_plant", "mart_generacion_por_central"),
    "plant_efficiency": ("plant_efficiency", "mart_eficiencia_central"),
    "system_summary": ("system_summary", "mart_resumen_sistema"),
    "training_solar": ("training_solar", "mart_training_solar"),
}

for _name, (_attr, _cte) in MODEL_QUERIES.items():
    register(_name, oracle.model(_cte))(_model(_attr))


def _load_extras() -> None:
    # Operator, quality, metric and IO queries register themselves on import.
    from . import queries_extra  # noqa: F401, PLC0415


_load_extras()
