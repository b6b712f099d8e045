"""Queries over written tables: buckets, stored partials, row checks counted by the
write, tables of a schema, the guarded scan, page state and wind archives."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from . import oracle as O
from .io_queries import _GEN_SQL, GEN_COLS, PAGE_SIZE
from .operators.quality import ROW_KINDS, run_checks
from .plans.pipeline import RUN_TS, Models, layout_of
from .plans.tests_declared import CHECKS
from .quality_queries import dq_sql
from .registry import register
from .schemas import GENERATION
from .session import scratch_path
from .sources import catalog, era5, testdata, testdata_files
from .sources.guarded import register_guarded
from .sources.stored import StoredRawTables
from .sources.testdata_files import IDS_PER_PAGE
from .streaming import files_per_trigger, latest_audit, stream_audit


def _stored(spark, sf, root: str, *tables: str) -> str:
    """Raw tables written as the loaders write them."""
    raw = testdata.raw_tables(spark, sf)
    for t in tables:
        src, df = catalog.SOURCES[t], getattr(raw, t)
        if src.partition_column:
            df = df.withColumn(src.partition_column, F.to_date(src.time_column))
        catalog.write_table(df, f"{root}/{t}", [src.partition_column] if src.partition_column else [], src.cluster_by)
    return root


@register("training_bucketed", O.model("mart_training_solar"))
def training_bucketed(spark, sf):
    """The training set joined from its two stored sides, bucket by bucket."""
    m = Models.from_testdata(spark, sf).materialize(scratch_path(spark, "bucketed"), [
        "stg_plants", "stg_era5_solar", "plants_geo", "era5_cells", "era5_features", "generation_enriched",
        "solar_target", "training_solar"])
    return m.training_solar


@register("efficiency_windowed", O.model("mart_eficiencia_central"))
def efficiency_windowed(spark, sf):
    """Lifetime figures after a run over everything and one over two days again: the
    second reads the stored daily partials, no hour outside its window."""
    root = scratch_path(spark, "windowed")
    raw = _stored(spark, sf, f"{root}/raw", "generacion_real", "centrales_info")
    names = ["stg_plants", "plants_geo", "generation_enriched", "plant_days", "plant_efficiency"]
    Models(spark, StoredRawTables(spark, raw, as_of=RUN_TS), RUN_TS, RUN_TS).materialize(root, names)
    window = StoredRawTables(spark, raw, "2024-04-03 00:00:00", "2024-04-05 00:00:00")
    return Models(spark, window, RUN_TS, RUN_TS).materialize(root, names).plant_efficiency


_ROW_CHECKS = [c for c in CHECKS if c.kind in ROW_KINDS]


@register("dq_observed", dq_sql(_ROW_CHECKS))
def dq_observed(spark, sf):
    """Row-level data tests, counted by the tasks that write the models."""
    models = {c.model for c in _ROW_CHECKS}
    m = Models.from_testdata(spark, sf).materialize(scratch_path(spark, "observed"), checks=CHECKS)
    return run_checks({n: getattr(m, n) for n in models}, _ROW_CHECKS, counted=m.observed)


@register("schema_table", O.sql("""
SELECT * FROM mart_generacion_por_central WHERE fecha BETWEEN DATE '2024-04-03' AND DATE '2024-04-06'""",
                                ["mart_generacion_por_central"]))
def schema_table(spark, sf):
    """A daily mart as a table of a named schema, over its day folders."""
    root = scratch_path(spark, "schema")
    names = ["stg_plants", "plants_geo", "generation_enriched", "plant_days", "daily_by_plant"]
    m = Models.from_testdata(spark, sf).materialize(root, names)
    # A schema for each run: a result may be read after another run registered its own.
    schema = "marts_" + hashlib.sha256(root.encode()).hexdigest()[:12]
    catalog.register_tables(spark, {n: (m.tables[n], layout_of(n)[0]) for n in names[-1:]}, schema)
    return spark.sql(f"SELECT * FROM {schema}.daily_by_plant "
                     "WHERE fecha BETWEEN DATE'2024-04-03' AND DATE'2024-04-06'")


@register("guarded_scan", O.sql(f"""
SELECT {_GEN_SQL} FROM raw_generacion WHERE fecha_hora >= TIMESTAMP '2024-04-03 00:00:00'
  AND fecha_hora < TIMESTAMP '2024-04-05 12:00:00' AND id_central > 3""", ["raw_generacion"]))
def guarded_scan(spark, sf):
    """SQL over the guarded raw table, with a bound on its day."""
    root = _stored(spark, sf, scratch_path(spark, "guarded"), "generacion_real")
    view = "guarded_" + hashlib.sha256(root.encode()).hexdigest()[:12]
    register_guarded(spark, root, "generacion_real", view)
    return spark.sql(f"SELECT {_GEN_SQL} FROM {view} WHERE fecha_hora >= TIMESTAMP_NTZ'2024-04-03 00:00:00' "
                     "AND fecha_hora < TIMESTAMP_NTZ'2024-04-05 12:00:00' AND id_central > 3")


@register("pages_stream_audit", O.sql(f"""
, per_page AS (SELECT id_opreal // {IDS_PER_PAGE} + 1 AS page, count(*) AS n FROM raw_generacion GROUP BY 1),
facts AS (SELECT count(*) AS pages, CAST(sum(n) AS BIGINT) AS rows,
    CAST(ceil(sum(n) / {PAGE_SIZE}.0) AS BIGINT) AS expected_pages, count(*) FILTER (n < {PAGE_SIZE}) AS short_pages,
    coalesce(min(page) FILTER (n < {PAGE_SIZE}), max(page)) = max(page) AS ordered FROM per_page),
gaps AS (SELECT *, pages = expected_pages AND ordered AS complete,
    expected_pages - (SELECT count(*) FROM per_page WHERE page <= expected_pages) AS n_missing FROM facts)
SELECT pages, rows, rows AS declared_total, expected_pages, short_pages, CAST(0 AS BIGINT) AS empty_pages, complete,
  n_missing, CASE WHEN complete THEN 'complete' WHEN n_missing > 0 THEN 'missing' ELSE 'short' END AS status
FROM gaps""", ["raw_generacion"]))
def pages_stream_audit(spark, sf):
    """Page files audited while they arrive: state for each series, the newest verdict."""
    raw = testdata.raw_generacion(spark, sf).select(*GEN_COLS)
    folder = testdata_files.write_pages(raw, pages_per_file=1)
    out = scratch_path(spark, "verdicts")
    schema = GENERATION.__class__([f for f in GENERATION.fields if f.name in GEN_COLS])
    stream_audit(spark, folder, schema, PAGE_SIZE, out, f"{out}-checkpoint",
                 max_files_per_trigger=files_per_trigger(spark, folder)).awaitTermination()
    return latest_audit(spark, out).select(
        "pages", "rows", "declared_total", "expected_pages", "short_pages", "empty_pages", "complete",
        F.size("missing").cast("bigint").alias("n_missing"), "status")


@register("era5_zip_wind", O.sql("""
SELECT valid_time, latitude, longitude, u100, v100, u10, v10, sp, t2m, i10fg,
       'era5_lat' || CAST(latitude AS VARCHAR) || '_lon' || CAST(longitude AS VARCHAR) || '_wind_'
         || CAST(year(valid_time) AS VARCHAR) AS entity
FROM raw_era5_wind""", ["raw_era5_wind"]))
def era5_zip_wind(spark, sf):
    """The wind preset's archives, read member by member in chunks."""
    root = scratch_path(spark, "era5-wind")
    testdata_files.write_archives(testdata.raw_tables(spark, sf).era5_wind, root, "wind").count()
    return era5.read_archives(spark, f"{root}/*.zip", "wind")
