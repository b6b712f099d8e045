"""IO queries: landed files, pages, archives and partitioned tables, written
under the shared checkpoint folder from the driver tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle as O
from .registry import register
from .schemas import GENERATION
from .session import scratch_path
from .sources import catalog, era5, landing, testdata, testdata_files
from .sources.testdata_files import IDS_PER_PAGE
from .streaming import stream_landing

GEN_COLS = ["id_opreal", "id_central", "gen_real_mw", "fecha_hora", "hora", "potencia_maxima",
            "tipo_tecnologia", "_extracted_at"]
_GEN_SQL = ", ".join(GEN_COLS)
PAGE_SIZE = 5000
ENTITY = "generacion-real_v3_findByDate"
RUN_DATE = "2026-06-01"
BATCH_A, BATCH_B = "2026-06-01 01:00:00", "2026-06-02 01:00:00"


def _raw(spark, sf):
    return testdata.raw_generacion(spark, sf)


@register("landing_roundtrip", O.sql(
    f"SELECT {_GEN_SQL.replace('_extracted_at', O.ts(BATCH_A) + ' AS _extracted_at')} FROM raw_generacion",
    ["raw_generacion"]))
def landing_roundtrip(spark, sf):
    """Raw rows -> landed JSONL batch (one stamp per batch) -> raw table."""
    root = scratch_path(spark, "landing")
    landing.write_landing(_raw(spark, sf), root, "cen", ENTITY, RUN_DATE, BATCH_A, batch_num=1)
    table = landing.load_landing(spark, root, "generacion_real", RUN_DATE, f"{root}/tables/generacion_real")
    return table.select(*GEN_COLS)


def _pages(spark, sf):
    """Page envelopes of the raw rows, read as pages."""
    schema = GENERATION.__class__([f for f in GENERATION.fields if f.name in GEN_COLS])
    return landing.read_pages(spark, testdata_files.write_pages(_raw(spark, sf).select(*GEN_COLS)), schema)


@register("pages_explode", O.sql(f"""
SELECT CAST(id_opreal // {IDS_PER_PAGE} + 1 AS BIGINT) AS page, count(*) OVER () AS declared_total,
       count(*) OVER (PARTITION BY id_opreal // {IDS_PER_PAGE}) AS page_rows, {_GEN_SQL}
FROM raw_generacion""", ["raw_generacion"]))
def pages_explode(spark, sf):
    """Raw rows -> page envelopes -> rows again, with page facts."""
    p = _pages(spark, sf)
    return p.select("page", "declared_total", F.col("page_rows").cast("bigint").alias("page_rows"),
                    *[F.col(f"row.{c}").alias(c) for c in GEN_COLS])


@register("pages_audit", O.sql(f"""
SELECT count(*) AS pages, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) AS BIGINT) AS declared_total,
       CAST(ceil(sum(n) / {PAGE_SIZE}.0) AS BIGINT) AS expected_pages, count(*) FILTER (n < {PAGE_SIZE}) AS short_pages,
       CAST(0 AS BIGINT) AS empty_pages, count(*) = ceil(sum(n) / {PAGE_SIZE}.0)
         AND coalesce(min(page) FILTER (n < {PAGE_SIZE}), max(page)) = max(page) AS complete
FROM (SELECT id_opreal // {IDS_PER_PAGE} AS page, count(*) AS n FROM raw_generacion GROUP BY 1) p""", ["raw_generacion"]))
def pages_audit(spark, sf):
    return landing.audit_pages(_pages(spark, sf), PAGE_SIZE)


@register("era5_zip", O.sql("""
SELECT valid_time, latitude, longitude, t2m, ssrd, tcc, fdir,
       'era5_lat' || CAST(latitude AS VARCHAR) || '_lon' || CAST(longitude AS VARCHAR) || '_solar_'
         || CAST(year(valid_time) AS VARCHAR) AS entity
FROM raw_era5_solar""", ["raw_era5_solar"]))
def era5_zip(spark, sf):
    """ERA5 rows -> one ZIP+CSV per grid point and year -> typed rows again."""
    raw = testdata.raw_tables(spark, sf).era5_solar
    root = scratch_path(spark, "era5")
    testdata_files.write_archives(raw, root, "solar").count()
    return era5.read_archives(spark, f"{root}/*.zip", "solar")


@register("partition_prune", O.sql(f"""
SELECT {_GEN_SQL} FROM raw_generacion
WHERE fecha_hora >= TIMESTAMP '2024-04-03 00:00:00' AND fecha_hora < TIMESTAMP '2024-04-06 00:00:00'""",
                                   ["raw_generacion"]))
def partition_prune(spark, sf):
    """Day-partitioned raw table; a bounded scan reads three day folders."""
    path = scratch_path(spark, "raw_generacion")
    raw = _raw(spark, sf).withColumn("fecha_part", F.to_date("fecha_hora"))
    catalog.write_table(raw, path, partition_by=["fecha_part"], cluster_by=["id_central"])
    df = catalog.scan_day_partitioned(spark, path, "fecha_hora", "2024-04-03 00:00:00", "2024-04-06 00:00:00")
    return df.select(*GEN_COLS)


@register("rows_for_day", O.sql("""
SELECT count(*) AS total_rows FROM raw_generacion WHERE CAST(fecha_hora AS DATE) = DATE '2024-09-08'""",
                                ["raw_generacion"]))
def rows_for_day(spark, sf):
    return catalog.rows_for_day(_raw(spark, sf), "fecha_hora", "2024-09-08")


@register("landing_inventory", O.sql(f"""
SELECT '{ENTITY}_00001.jsonl' AS name, count(*) AS lines FROM raw_generacion
UNION ALL SELECT 'centrales_v4_findByDate.jsonl', count(*) FROM raw_centrales""", ["raw_generacion", "raw_centrales"]))
def landing_inventory(spark, sf):
    """Objects landed for a source and date, with their lines."""
    root = scratch_path(spark, "inventory")
    landing.write_landing(_raw(spark, sf), root, "cen", "/generacion-real/v3/findByDate/",
                          RUN_DATE, BATCH_A, batch_num=1)
    landing.write_landing(testdata.raw_centrales(spark, sf), root, "cen", "/centrales/v4/findByDate/",
                          RUN_DATE, BATCH_A)
    return landing.inventory(spark, root, "cen", RUN_DATE).select("name", "lines")


@register("stream_load", O.sql(f"""
SELECT {_GEN_SQL.replace('_extracted_at', 'CASE WHEN (id_opreal // 10) % 2 = 0 THEN ' + O.ts(BATCH_A)
                         + ' ELSE ' + O.ts(BATCH_B) + ' END AS _extracted_at')}
FROM raw_generacion""", ["raw_generacion"]))
def stream_load(spark, sf):
    """Two landing dates picked up incrementally by a file stream and
    appended to the day-partitioned raw table."""
    root = scratch_path(spark, "stream")
    raw = _raw(spark, sf)
    even = (F.floor(F.col("id_opreal") / 10) % 2) == 0
    landing.write_landing(raw.filter(even), root, "cen", ENTITY, "2026-06-01", BATCH_A, 1)
    landing.write_landing(raw.filter(~even), root, "cen", ENTITY, "2026-06-02", BATCH_B, 1)
    table = f"{root}/tables/generacion_real"
    q = stream_landing(spark, root, "generacion_real", table, f"{root}/_checkpoints/generacion_real")
    q.awaitTermination()
    return spark.read.parquet(table).select(*GEN_COLS)


BATCH_C = "2026-06-03 01:00:00"


@register("mixed_load", O.sql(f"""
SELECT {_GEN_SQL.replace('_extracted_at', 'CASE (id_opreal // 10) % 3 WHEN 0 THEN ' + O.ts(BATCH_A) + ' WHEN 1 THEN '
                         + O.ts(BATCH_B) + ' ELSE ' + O.ts(BATCH_C) + ' END AS _extracted_at')}
FROM raw_generacion""", ["raw_generacion"]))
def mixed_load(spark, sf):
    """One raw table loaded by batch, then by stream, then by batch again."""
    root = scratch_path(spark, "mixed")
    third = F.floor(F.col("id_opreal") / 10) % 3
    table = f"{root}/tables/generacion_real"
    raw = _raw(spark, sf)
    landing.write_landing(raw.filter(third == 0), f"{root}/a", "cen", ENTITY, "2026-06-01", BATCH_A)
    landing.write_landing(raw.filter(third == 1), f"{root}/b", "cen", ENTITY, "2026-06-02", BATCH_B)
    landing.write_landing(raw.filter(third == 2), f"{root}/a", "cen", ENTITY, "2026-06-03", BATCH_C)
    landing.load_landing(spark, f"{root}/a", "generacion_real", "2026-06-01", table)
    stream_landing(spark, f"{root}/b", "generacion_real", table, f"{root}/_checkpoints/g").awaitTermination()
    return landing.load_landing(spark, f"{root}/a", "generacion_real", "2026-06-03", table).select(*GEN_COLS)


_REWRITTEN = {"fact_hourly": "fct_generacion_hora", "daily_by_plant": "mart_generacion_por_central",
              "system_summary": "mart_resumen_sistema"}


@register("mart_rewrite", O.sql(" UNION ALL ".join(
    f"SELECT '{n}' AS model, fecha, count(*) AS n FROM {c} WHERE fecha <> DATE '2024-04-05' GROUP BY fecha"
    for n, c in _REWRITTEN.items()), list(_REWRITTEN.values())))
def mart_rewrite(spark, sf):
    """Marts written whole, then written again without one day: it is gone from all."""
    from types import SimpleNamespace  # noqa: PLC0415

    from .plans.pipeline import RUN_TS, Models  # noqa: PLC0415
    root, raw = scratch_path(spark, "rewrite"), testdata.raw_tables(spark, sf)
    names = ["plants_geo", "generation_enriched", *_REWRITTEN]
    Models(spark, raw, RUN_TS, RUN_TS).materialize(root, names)
    less = SimpleNamespace(centrales_info=raw.centrales_info, era5_solar=raw.era5_solar, generacion_real=raw
                           .generacion_real.filter(F.to_date("fecha_hora") != F.lit("2024-04-05").cast("date")))
    Models(spark, less, RUN_TS, RUN_TS).materialize(root, names)
    parts = [spark.read.parquet(f"{root}/{n}").groupBy("fecha").agg(F.count("*").alias("n"))
             .select(F.lit(n).alias("model"), "fecha", "n") for n in _REWRITTEN]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("era5_solar_load", O.sql("SELECT * FROM raw_era5_solar", ["raw_era5_solar"]))
def era5_solar_load(spark, sf):
    """Solar variables: landed as JSONL for one date and appended to the raw table."""
    root = scratch_path(spark, "solar")
    landing.write_landing(testdata.raw_tables(spark, sf).era5_solar, root, "era5", "era5_grid_solar", RUN_DATE,
                          testdata.ERA5_STAMP)
    table = landing.load_landing(spark, root, "era5_solar", RUN_DATE, f"{root}/tables/era5_solar")
    return table.drop("fecha_part")


@register("utm_sql_function", O.sql("""
SELECT id_central, coordenada_este_utm, coordenada_norte_utm, zona_huso, latitude, longitude
FROM int_centrales_geo""", ["int_centrales_geo"]))
def utm_sql_function(spark, sf):
    """The projection as a SQL function."""
    from .functions.sql import register_sql_functions  # noqa: PLC0415
    from .plans.pipeline import Models  # noqa: PLC0415
    register_sql_functions(spark)
    plants = Models.from_testdata(spark, sf).plants_geo.select(
        "id_central", "coordenada_este_utm", "coordenada_norte_utm", "zona_huso")
    point = F.expr("utm_to_latlon(coordenada_este_utm, coordenada_norte_utm, zona_huso)")
    return plants.withColumn("p", point).select("*", "p.latitude", "p.longitude").drop("p")


@register("era5_wind_load", O.sql("SELECT * FROM raw_era5_wind", ["raw_era5_wind"]))
def era5_wind_load(spark, sf):
    """Wind variables: landed as JSONL for one date and appended to the
    day-partitioned raw table (the raw contract; no model reads it)."""
    root = scratch_path(spark, "wind")
    wind = testdata.raw_tables(spark, sf).era5_wind
    landing.write_landing(wind, root, "era5", "era5_grid_wind", RUN_DATE, testdata.ERA5_STAMP)
    table = landing.load_landing(spark, root, "era5_wind", RUN_DATE, f"{root}/tables/era5_wind")
    return table.drop("fecha_part")


@register("registry_replace", O.sql(f"""
SELECT id_central, central, region, provincia, comuna, tipo_tecnologia, coordenada_este,
       coordenada_norte, zona_huso, {O.ts(BATCH_B)} AS _extracted_at
FROM raw_centrales""", ["raw_centrales"]))
def registry_replace(spark, sf):
    """Plant registry loads replace the table: two landing dates are loaded
    in turn and only the second survives."""
    root = scratch_path(spark, "registry")
    cen = testdata.raw_centrales(spark, sf)
    table = f"{root}/tables/centrales_info"
    landing.write_landing(cen.filter("id_central % 2 = 0"), root, "cen", "centrales_v4_findByDate",
                          "2026-06-01", BATCH_A)
    landing.load_landing(spark, root, "centrales_info", "2026-06-01", table)
    landing.write_landing(cen, root, "cen", "centrales_v4_findByDate", "2026-06-02", BATCH_B)
    out = landing.load_landing(spark, root, "centrales_info", "2026-06-02", table)
    return out.select("id_central", "central", "region", "provincia", "comuna", "tipo_tecnologia",
                      "coordenada_este", "coordenada_norte", "zona_huso", "_extracted_at")


@register("extraction_slice", O.sql(f"""
SELECT {_GEN_SQL} FROM raw_generacion
WHERE CAST(fecha_hora AS DATE) BETWEEN DATE '2024-09-01' AND DATE '2024-09-03' AND id_central = 7""",
                                    ["raw_generacion"]))
def extraction_slice_q(spark, sf):
    return catalog.extraction_slice(_raw(spark, sf), "fecha_hora", "2024-09-01", "2024-09-03",
                                    id_central=7).select(*GEN_COLS)
