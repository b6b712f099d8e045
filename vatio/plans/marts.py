"""Mart models M9-M15.

The daily marts read the normal-state hourly rows once. Where the literal
definition reads the source several times (capacity, hourly peak, top
technology, distinct active plants) the plans below pre-aggregate first and
roll up from there; distinct counts become counts of plant groups whose max
generation is positive, so no Expand-based distinct aggregation is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.energy import CONVENTIONAL, RENEWABLE, classify_source
from ..functions.numeric import round_half_away, safe_divide
from ..operators.joins import join_dimension

HOURS_PER_DAY = 24.0


def _normal(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("state_central") == "normal")


FACT_HOURLY_OUT = ["id_central", "nombre_central", "tipo_tecnologia", "region", "comuna",
                   "provincia", "geo_point", "generacion_real_mw", "potencia_maxima_mw",
                   "factor_planta", "timestamp_local", "timestamp_utc", "fecha", "hora", "mes",
                   "anio"]


def fact_hourly(enriched: DataFrame) -> DataFrame:
    """M9: hourly fact of normal plants."""
    return _normal(enriched).select(*FACT_HOURLY_OUT)


def _daily_factor(total, capacity) -> F.Column:
    return round_half_away(safe_divide(total, capacity * F.lit(HOURS_PER_DAY)), 4)


def daily_by_technology(enriched: DataFrame) -> DataFrame:
    """Day x technology x class.

    Grain note: technology is the generation row's, class is the registry's,
    so one (day, technology) can carry two classes; each such row reports the
    full (day, technology) capacity. Rows with NULL technology are dropped
    (they have no capacity row to join).

    Plan: rows -> (day, tech, class, plant) partials -> GROUPING SETS
    {(day, tech, class), (day, tech, plant)} -> (day, tech): capacity plus the
    (at most two) class rows carried in a small array. A straight chain of
    aggregates, so no branch re-reads the hourly rows.
    """
    s = _normal(enriched)
    gen = F.col("generacion_real_mw")
    per_plant = s.groupBy("fecha", "tipo_tecnologia", "clasificacion_fuente", "id_central").agg(
        F.sum(gen).alias("g"), F.count(gen).alias("n"), F.max(gen).alias("mx"),
        F.count_if(gen > 0).alias("hrs"), F.max("potencia_maxima_mw").alias("p"))
    sets = per_plant.groupingSets(
        [["fecha", "tipo_tecnologia", "clasificacion_fuente"], ["fecha", "tipo_tecnologia", "id_central"]],
        "fecha", "tipo_tecnologia", "clasificacion_fuente", "id_central",
    ).agg(F.grouping_id().alias("gid"), F.sum("g").alias("g"), F.sum("n").alias("n"),
          F.max("mx").alias("mx"), F.sum("hrs").alias("hrs"),
          F.count_if(F.col("mx") > 0).alias("active"), F.max("p").alias("p"))
    by_class = F.col("gid") == 1            # id_central rolled up
    per_plant_rows = F.col("gid") == 2      # clasificacion_fuente rolled up
    per_tech = sets.groupBy("fecha", "tipo_tecnologia").agg(
        F.sum(F.when(per_plant_rows, F.col("p"))).alias("capacidad_instalada_mw"),
        F.collect_list(F.when(by_class, F.struct(
            "clasificacion_fuente", "g", "n", "mx", "hrs", "active"))).alias("classes"))
    rows = per_tech.filter(F.col("tipo_tecnologia").isNotNull()) \
        .select("fecha", "tipo_tecnologia", "capacidad_instalada_mw", F.explode("classes").alias("c"))
    total = F.col("c.g")
    return rows.select(
        "fecha", "tipo_tecnologia", F.col("c.clasificacion_fuente").alias("clasificacion_fuente"),
        total.alias("generacion_total_mwh"),
        round_half_away(safe_divide(total, F.col("c.n")), 2).alias("generacion_promedio_mw"),
        F.col("c.mx").alias("generacion_maxima_mw"), F.col("c.hrs").alias("horas_con_generacion"),
        F.col("c.active").alias("num_centrales_activas"), "capacidad_instalada_mw",
        _daily_factor(total, F.col("capacidad_instalada_mw")).alias("factor_planta"),
    )


def plant_days(enriched: DataFrame) -> DataFrame:
    """Mergeable partials of normal plants, one row per day and plant.

    The daily plant mart and the lifetime figures are both made from these rows
    (sums, counts and extremes combine); stored by day, a run over a window
    replaces its days and the lifetime figures read no hourly row again.

    Text cannot be the buffer of a hash aggregate, so the hours are grouped by
    the row's technology as well, and its least value is taken from the few
    rows that remain of a day and plant.
    """
    gen = F.col("generacion_real_mw")
    per_tech = _normal(enriched).groupBy("fecha", "id_central", "tipo_tecnologia").agg(
        F.sum(gen).alias("mwh"), F.count(gen).alias("n"), F.max(gen).alias("mx"), F.min(gen).alias("mn"),
        F.max("potencia_maxima_mw").alias("rated"), F.count_if(gen > 0).alias("running"),
        F.count(F.lit(1)).alias("hours"))
    return per_tech.groupBy("fecha", "id_central").agg(
        F.min("tipo_tecnologia").alias("tipo_tecnologia"), F.sum("mwh").alias("mwh"), F.sum("n").alias("n"),
        F.max("mx").alias("mx"), F.min("mn").alias("mn"), F.max("rated").alias("rated"),
        F.sum("running").alias("running"), F.sum("hours").alias("hours"))


def _plant_attributes(plants: DataFrame, *more) -> DataFrame:
    """What a plant's id determines: one row per plant."""
    return plants.select("id_central", "nombre_central",
                         classify_source("tipo_tecnologia").alias("clasificacion_fuente"),
                         "region", "comuna", "latitude", "longitude", *more)


def daily_by_plant(days: DataFrame, plants: DataFrame, plants_small: bool | None = None) -> DataFrame:
    """Day x plant, from ``plant_days``. The plant's attributes depend on its
    id alone and are looked up after the aggregate; the technology is the rows'
    own and may vary inside a day: its minimum (a repeatable 'any value')."""
    joined = join_dimension(days, _plant_attributes(plants), "id_central", small=plants_small)
    return joined.select(
        "fecha", "id_central", "nombre_central", "tipo_tecnologia", "clasificacion_fuente",
        "region", "comuna", "latitude", "longitude", F.col("mwh").alias("generacion_total_mwh"),
        round_half_away(safe_divide("mwh", "n"), 2).alias("generacion_promedio_mw"),
        F.col("mx").alias("generacion_maxima_mw"), F.col("mn").alias("generacion_minima_mw"),
        F.col("rated").alias("potencia_maxima_mw"),
        _daily_factor(F.col("mwh"), F.col("rated")).alias("factor_planta"),
        F.col("running").alias("horas_operacion"), F.col("hours").alias("horas_con_datos"))


def plant_efficiency(days: DataFrame, plants: DataFrame, plants_small: bool | None = None) -> DataFrame:
    """Lifetime KPIs per normal plant, from ``plant_days`` (daily -> daily factor -> all-time)."""
    daily = days.withColumn("d_factor", safe_divide("mwh", F.col("rated") * F.lit(HOURS_PER_DAY)))
    per_plant = daily.groupBy("id_central").agg(
        F.count("fecha").alias("dias_con_datos"),
        F.sum("mwh").alias("generacion_total_mwh"),
        round_half_away(F.avg("mwh"), 2).alias("generacion_promedio_diaria_mwh"),
        F.max("rated").alias("potencia_maxima_mw"),
        round_half_away(F.avg("d_factor"), 4).alias("factor_planta_promedio"),
        round_half_away(F.max("d_factor"), 4).alias("factor_planta_mejor_dia"),
        F.sum("running").alias("horas_operacion_totales"),
        F.sum("hours").alias("horas_con_datos_totales"))
    info = _plant_attributes(_normal(plants), F.col("tipo_tecnologia"), F.col("geo_point"))
    joined = join_dimension(per_plant, info, "id_central", small=plants_small)
    return joined.select(
        "id_central", "nombre_central", "tipo_tecnologia", "clasificacion_fuente", "region",
        "comuna", "latitude", "longitude", "geo_point", "dias_con_datos", "generacion_total_mwh",
        "generacion_promedio_diaria_mwh", "potencia_maxima_mw", "factor_planta_promedio",
        "factor_planta_mejor_dia", "horas_operacion_totales", "horas_con_datos_totales",
        round_half_away(safe_divide("horas_operacion_totales", "horas_con_datos_totales"), 4)
        .alias("tasa_disponibilidad"))


def system_summary(enriched: DataFrame) -> DataFrame:
    """One row per day for the whole system.

    One chain of aggregates over a single read of the hourly rows:
    1. GROUPING SETS {(day, plant, tech, class), (day, hour)}: energy, max
       output and max rating per plant-tech, and energy per local hour.
    2. GROUPING SETS {(day, plant), (day, tech), (day, hour)} over those
       partials: capacity and activity per plant, energy per technology,
       system energy per hour. Each aggregate only counts the step-1 rows of
       its own kind (``when`` on the step-1 grouping id).
    3. per day: sums over plants, peak and valley over hours, and the top
       technology (largest energy, ties to the smaller name).
    Distinct active plants are counted as plant groups with positive output.
    """
    s = _normal(enriched)
    gen = F.col("generacion_real_mw")
    keys = ["fecha", "id_central", "tipo_tecnologia", "clasificacion_fuente", "hora"]
    step1 = s.groupingSets(
        [["fecha", "id_central", "tipo_tecnologia", "clasificacion_fuente"], ["fecha", "hora"]], *keys,
    ).agg(F.grouping_id().alias("g1"), F.sum(gen).alias("g"), F.max(gen).alias("mx"),
          F.max("potencia_maxima_mw").alias("p"))
    plant_tech = F.col("g1") == 1           # hour rolled up
    hourly = F.col("g1") == 14              # plant, tech and class rolled up
    ren = F.col("clasificacion_fuente") == RENEWABLE
    conv = F.col("clasificacion_fuente") == CONVENTIONAL

    def only(cond, c):
        return F.when(cond, F.col(c))

    step2 = step1.groupingSets(
        [["fecha", "id_central"], ["fecha", "tipo_tecnologia"], ["fecha", "hora"]],
        "fecha", "id_central", "tipo_tecnologia", "hora",
    ).agg(F.grouping_id().alias("g2"),
          F.count_if(plant_tech).alias("n_pt"), F.count_if(hourly).alias("n_h"),
          F.sum(only(plant_tech, "g")).alias("g"),
          F.sum(F.when(plant_tech, F.when(ren, F.col("g")).otherwise(F.lit(0.0)))).alias("ren"),
          F.sum(F.when(plant_tech, F.when(conv, F.col("g")).otherwise(F.lit(0.0)))).alias("conv"),
          F.max(only(plant_tech, "mx")).alias("mx"),
          F.max(F.when(plant_tech & ren, F.col("mx"))).alias("mx_ren"),
          F.max(only(plant_tech, "p")).alias("p"),
          F.sum(only(hourly, "g")).alias("hour_g"))
    plant = (F.col("g2") == 3) & (F.col("n_pt") > 0)      # (day, plant)
    tech = (F.col("g2") == 5) & (F.col("n_pt") > 0)       # (day, tech)
    hour = (F.col("g2") == 6) & (F.col("n_h") > 0)        # (day, hour)
    top = F.min(F.when(tech, F.struct(F.col("g").isNull().alias("n"), (-F.col("g")).alias("v"),
                                      F.col("tipo_tecnologia").alias("t"))))
    daily = step2.groupBy("fecha").agg(
        F.sum(F.when(plant, F.col("g"))).alias("generacion_total_mwh"),
        F.sum(F.when(plant, F.col("ren"))).alias("generacion_renovable_mwh"),
        F.sum(F.when(plant, F.col("conv"))).alias("generacion_convencional_mwh"),
        F.max(F.when(hour, F.col("hour_g"))).alias("demanda_maxima_mw"),
        F.min(F.when(hour, F.col("hour_g"))).alias("demanda_minima_mw"),
        F.count_if(plant & (F.col("mx") > 0)).alias("num_centrales_activas"),
        F.count_if(plant & (F.col("mx_ren") > 0)).alias("num_centrales_renovables_activas"),
        F.sum(F.when(plant, F.col("p"))).alias("capacidad_instalada_total_mw"),
        top.alias("top"))
    total = F.col("generacion_total_mwh")
    return daily.select(
        "fecha", "generacion_total_mwh", "generacion_renovable_mwh", "generacion_convencional_mwh",
        round_half_away(safe_divide("generacion_renovable_mwh", total) * F.lit(100.0), 2).alias("pct_renovable"),
        round_half_away(safe_divide("generacion_convencional_mwh", total) * F.lit(100.0), 2).alias("pct_convencional"),
        "demanda_maxima_mw", "demanda_minima_mw", "num_centrales_activas",
        "num_centrales_renovables_activas", "capacidad_instalada_total_mw",
        _daily_factor(total, F.col("capacidad_instalada_total_mw")).alias("factor_planta_sistema"),
        F.col("top.t").alias("top_tecnologia"))


TRAINING_OUT = ["id_central", "timestamp_utc", "fecha", "lat_era5", "lon_era5", "factor_planta",
                "temperatura_celsius", "ghi_wm2", "dni_wm2", "nubosidad_pct", "fraccion_directa",
                "hora_cos", "hora_sin", "mes_cos", "mes_sin"]


#: Integer grid indices of a weather cell, round(deg * 4): exact, as cells are quarter degrees.
CELL_KEYS = ("cell_i", "cell_j")
#: Join key of the training set, and bucket key of both its sides when they are stored.
TRAINING_KEYS = (*CELL_KEYS, "timestamp_utc")


def with_cell_keys(df: DataFrame) -> DataFrame:
    """``df`` with the grid indices of its cell; a stored table has them already."""
    if CELL_KEYS[0] in df.columns:
        return df
    return (df.withColumn(CELL_KEYS[0], F.round(F.col("lat_era5") * F.lit(4.0)).cast("int"))
              .withColumn(CELL_KEYS[1], F.round(F.col("lon_era5") * F.lit(4.0)).cast("int")))


def training_solar(target: DataFrame, features: DataFrame) -> DataFrame:
    """Solar target rows with the weather of their cell and UTC hour.

    Both sides are large (plants x hours, cells x hours): a join on the cell's
    grid indices and the hour — the same equality as on the doubles, with integer
    hashing and no float normalisation of the keys. Sides stored in buckets of
    these keys (``pipeline.BUCKETED``) meet bucket by bucket, without a shuffle.
    """
    feats = with_cell_keys(features).select(*TRAINING_KEYS, *TRAINING_OUT[6:])
    return with_cell_keys(target).join(feats, list(TRAINING_KEYS), "inner").select(*TRAINING_OUT)


# The calendar spine bounds.
SPINE_START, SPINE_END = "2019-01-01", "2030-12-31"


def time_spine(spark, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """One row per day, inclusive."""
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))).alias("date_day"))
