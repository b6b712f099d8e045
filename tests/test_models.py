"""Model properties on sf0.001 (the §5 property list)."""

from datetime import datetime

from pyspark.sql import functions as F


def test_dedup_unique_keys(models):
    stg = models.stg_generation
    assert stg.groupBy("id_central", "timestamp_utc").count().filter("count > 1").count() == 0


def test_short_day_collision_keeps_one(models):
    stg = models.stg_generation
    raw_keys = models.raw.generacion_real.filter(
        ((F.to_date("fecha_hora") == "2024-09-08") & (F.col("hora") == 24))
        | ((F.to_date("fecha_hora") == "2024-09-09") & (F.col("hora") == 1)))
    if raw_keys.count() == 0:
        return
    got = stg.filter(F.col("timestamp_utc") == datetime(2024, 9, 9, 3))
    assert got.groupBy("id_central").count().filter("count > 1").count() == 0


def test_energy_balances(models):
    m11 = models.daily_by_plant.agg(F.sum("generacion_total_mwh")).first()[0]
    m13 = models.system_summary.agg(F.sum("generacion_total_mwh")).first()[0]
    assert m11 == m13
    normal = models.generation_enriched.filter("state_central = 'normal' AND tipo_tecnologia IS NOT NULL")
    m10 = models.daily_by_technology.agg(F.sum("generacion_total_mwh")).first()[0]
    assert m10 == normal.agg(F.sum("generacion_real_mw")).first()[0]
    bad = models.system_summary.filter(
        F.col("generacion_renovable_mwh") + F.col("generacion_convencional_mwh") != F.col("generacion_total_mwh"))
    assert bad.count() == 0


def test_cell_distance_within_half_diagonal(models):
    # half of a 0.25 deg cell diagonal is at most ~19.3 km at these latitudes
    assert models.era5_cells.filter("distancia_era5_metros > 19300").count() == 0


def test_newest_located_version(models):
    geo = {r.id_central: r for r in models.plants_geo.collect()}
    stg = models.stg_plants
    for r in stg.filter("id_central % 10 = 0 AND coordenada_este_utm IS NULL").collect():
        if r.id_central in geo:   # older located version wins
            assert geo[r.id_central]._extracted_at < r._extracted_at
    for r in stg.filter("id_central % 10 = 5 AND state_central = 'en_revision'").collect():
        if r.id_central in geo and geo[r.id_central].latitude is not None:
            assert geo[r.id_central].state_central == "en_revision"


def test_output_contracts(models):
    assert models.stg_generation.columns == ["id_central", "tipo_tecnologia", "generacion_real_mw",
                                             "potencia_maxima_mw", "timestamp_local", "timestamp_utc",
                                             "_extracted_at", "_loaded_at"]
    assert len(models.training_solar.columns) == 15
    assert models.time_spine.count() == 4383
    types = dict(models.generation_enriched.dtypes)
    assert types["hora"] == "bigint" and types["timestamp_utc"] == "timestamp_ntz"


def _final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0]


def test_daily_marts_read_hourly_rows_once(models):
    """No branch of the daily plans re-reads the generation source."""
    for df in (models.system_summary, models.daily_by_technology):
        plan = _final_plan(df)
        assert plan.count("lineitem.parquet") == 1
        assert "Expand" in plan and "ReusedExchange" not in plan


def test_run_pipeline(spark):
    from vatio.plans.pipeline import MODEL_ORDER, run_pipeline
    from vatio.session import scratch_path
    from vatio.sources.testdata import raw_tables
    from conftest import SF_SMALL
    root = scratch_path(spark, "pipeline")
    res = run_pipeline(spark, raw_tables(spark, SF_SMALL), root, run_ts="2026-06-01 00:00:00")
    assert res.count() == 82
    daily = spark.read.parquet(f"{root}/system_summary")
    assert "fecha" in daily.columns and daily.count() > 0
    assert len(MODEL_ORDER) == 15   # the fourteen models and the stored daily partials
