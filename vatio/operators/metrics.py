"""Semantic metrics (L1-L18): named aggregations over the marts, grouped by
categorical dimensions and by a time grain of the model's time dimension.

``query_metrics`` evaluates all requested metrics of one model in a single
aggregate; metrics from different models are full-outer-joined on the
requested keys. Averages are reported to 1e-8 so they do not depend on the
order in which partial sums are combined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_half_away

AVERAGE_DIGITS = 8


@dataclass(frozen=True)
class Metric:
    name: str
    model: str
    agg: str
    expr: str
    time_dimension: str


METRICS: dict[str, Metric] = {m.name: m for m in [
    Metric("generacion", "fact_hourly", "sum", "generacion_real_mw", "timestamp_utc"),
    Metric("generacion_diaria_total", "daily_by_technology", "sum", "generacion_total_mwh", "fecha"),
    Metric("promedio_generacion_diaria_mw", "daily_by_technology", "average", "generacion_promedio_mw", "fecha"),
    Metric("maxima_generacion_diaria_mw", "daily_by_technology", "max", "generacion_maxima_mw", "fecha"),
    Metric("centrales_activas_diarias", "daily_by_technology", "max", "num_centrales_activas", "fecha"),
    Metric("factor_planta_diario_promedio", "daily_by_technology", "average", "factor_planta", "fecha"),
    Metric("generacion_sistema_total", "system_summary", "sum", "generacion_total_mwh", "fecha"),
    Metric("generacion_renovable_total", "system_summary", "sum", "generacion_renovable_mwh", "fecha"),
    Metric("generacion_convencional_total", "system_summary", "sum", "generacion_convencional_mwh", "fecha"),
    Metric("pct_renovable_promedio", "system_summary", "average", "pct_renovable", "fecha"),
    Metric("demanda_maxima_promedio", "system_summary", "max", "demanda_maxima_mw", "fecha"),
    Metric("centrales_activas_sistema_max", "system_summary", "max", "num_centrales_activas", "fecha"),
    Metric("capacidad_instalada_total_promedio", "system_summary", "average",
           "capacidad_instalada_total_mw", "fecha"),
    Metric("factor_planta_sistema_promedio", "system_summary", "average", "factor_planta_sistema", "fecha"),
]}

DIMENSIONS: dict[str, tuple[str, ...]] = {
    "fact_hourly": ("nombre_central", "tipo_tecnologia", "region", "comuna", "provincia"),
    "daily_by_technology": ("tipo_tecnologia", "clasificacion_fuente"),
    "system_summary": ("top_tecnologia",),
}

#: From fine to coarse; a week may cross months, so it is a grain of its own between day and month.
GRAINS = ("hour", "day", "week", "month", "quarter", "year")

# The declared granularity of each model's time dimension.
MODEL_GRAIN = {"fact_hourly": "hour", "daily_by_technology": "day", "system_summary": "day"}

# Entity "central": models keyed by id_central can be grouped by attributes of
# the plant dimension, written as central__<attribute>.
ENTITY_PREFIX = "central__"
ENTITY_KEY = "id_central"
ENTITY_MODELS = ("fact_hourly",)


def time_key(col: Column, grain: str) -> Column:
    """Truncate to ``grain``; day and coarser grains give a DATE."""
    if grain == "hour":
        return F.date_trunc("hour", col).cast("timestamp_ntz")
    d = F.to_date(col)
    return d if grain == "day" else F.trunc(d, grain)


def _agg(m: Metric) -> Column:
    x = F.col(m.expr)
    if m.agg == "sum":
        return F.sum(x)
    if m.agg == "max":
        return F.max(x)
    if m.agg == "min":
        return F.min(x)
    if m.agg == "count":
        return F.count(x)
    if m.agg == "average":
        return round_half_away(F.avg(x), AVERAGE_DIGITS)
    raise ValueError(m.agg)


def query_metrics(tables: Mapping[str, DataFrame], metrics: Sequence[str],
                  group_by: Sequence[str] = (), grain: str | None = None,
                  where: Column | None = None) -> DataFrame:
    """One row per group key: ``metric_time`` (when ``grain``) + ``group_by``."""
    by_model: dict[str, list[Metric]] = {}
    for name in metrics:
        m = METRICS[name]
        by_model.setdefault(m.model, []).append(m)
    keys = (["metric_time"] if grain else []) + list(group_by)
    frames = []
    for model, ms in by_model.items():
        entity_dims = [d for d in group_by if d.startswith(ENTITY_PREFIX)]
        bad = [d for d in group_by if d not in DIMENSIONS[model] and d not in entity_dims]
        if bad or (entity_dims and model not in ENTITY_MODELS):
            raise ValueError(f"{bad or entity_dims} are not dimensions of {model}")
        df = tables[model]
        if entity_dims:
            from .joins import join_dimension  # noqa: PLC0415
            attrs = tables["plants_geo"].select(
                ENTITY_KEY, *[F.col(d[len(ENTITY_PREFIX):]).alias(d) for d in entity_dims])
            df = join_dimension(df, attrs, ENTITY_KEY, "left")
        if where is not None:
            df = df.filter(where)
        if grain:
            if grain not in GRAINS:
                raise ValueError(f"{grain} is not one of {', '.join(GRAINS)}")
            if GRAINS.index(grain) < GRAINS.index(MODEL_GRAIN[model]):
                raise ValueError(f"{model} has a row per {MODEL_GRAIN[model]}: {grain} is finer")
            df = df.withColumn("metric_time", time_key(F.col(ms[0].time_dimension), grain))
        aggs = [_agg(m).alias(m.name) for m in ms]
        frames.append(df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs))
    if len(frames) == 1:
        return frames[0]
    if not keys:   # one-row frames: attach side by side on a constant key
        frames = [f.withColumn("__one", F.lit(1)) for f in frames]
        return reduce(lambda a, b: a.join(b, "__one"), frames).drop("__one")
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), frames)


def on_spine(metric_frame: DataFrame, spine: DataFrame, key: str = "metric_time") -> DataFrame:
    """Left join a day-grain metric frame onto a calendar spine (empty days
    appear with NULL metrics)."""
    return spine.withColumnRenamed("date_day", key).join(metric_frame, key, "left")
