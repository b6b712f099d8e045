import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vatio.plans.pipeline import Models
from vatio.schemas import GENERATION
from vatio.session import scratch_path
from vatio.sources import catalog, landing, testdata_files
from vatio.sources.stored import StoredRawTables
from vatio.sources.testdata import raw_tables


def test_pages_shapes(spark, tmp_path):
    rows = [{"id_central": i, "gen_real_mw": float(i)} for i in range(3)]
    (tmp_path / "a.json").write_text(json.dumps({"data": rows[:2], "totalCount": 3, "page": 1}))
    (tmp_path / "b.json").write_text(json.dumps(rows[2:]))
    (tmp_path / "c.json").write_text(json.dumps({"other": [], "total": 0}))
    schema = GENERATION.__class__([f for f in GENERATION.fields if f.name in ("id_central", "gen_real_mw")])
    got = landing.read_pages(spark, str(tmp_path), schema)
    ids = sorted(r.row.id_central for r in got.filter(F.col("row").isNotNull()).collect())
    assert ids == [0, 1, 2]
    totals = {os.path.basename(r.file): r.declared_total for r in got.collect()}
    assert totals["a.json"] == 3 and totals["c.json"] is None


def test_pages_in_lines_and_over_several_lines(spark, tmp_path):
    rows = [{"id_central": i, "gen_real_mw": float(i)} for i in range(5)]
    envelopes = [{"data": rows[:2], "totalCount": 5}, {"data": rows[2:4], "totalCount": 5}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, envelopes)))
    (tmp_path / "b.json").write_text(json.dumps({"data": rows[4:], "totalCount": 5}, indent=1))
    schema = GENERATION.__class__([f for f in GENERATION.fields if f.name in ("id_central", "gen_real_mw")])
    pages = landing.read_pages(spark, str(tmp_path), schema)
    assert sorted(r.row.id_central for r in pages.collect()) == [0, 1, 2, 3, 4]
    audit = landing.audit_pages(pages, 2).first()
    assert (audit.pages, audit.rows, audit.short_pages, audit.complete) == (3, 5, 1, True)


def test_short_page_inside_a_series_is_incomplete(spark, tmp_path):
    rows = [{"id_central": i} for i in range(5)]
    for page, part in ((1, rows[:2]), (2, rows[2:3]), (3, rows[3:])):
        (tmp_path / f"{page}.json").write_text(json.dumps({"data": part, "totalCount": 5, "page": page}))
    schema = GENERATION.__class__([f for f in GENERATION.fields if f.name == "id_central"])
    audit = landing.audit_pages(landing.read_pages(spark, str(tmp_path), schema), 2).first()
    assert (audit.pages, audit.rows, audit.complete) == (3, 5, False)


def test_broken_landing_line_fails_the_load(spark, tmp_path):
    folder = tmp_path / "cen" / "2026-01-01"
    folder.mkdir(parents=True)
    for bad in ('{"id_central": 1', '{"id_central": 1, "gen_real_mw": "many"}'):
        (folder / "generacion-real_v3.jsonl").write_text('{"id_central": 2, "gen_real_mw": 1.0}\n' + bad)
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
            landing.read_landing(spark, str(tmp_path), "generacion_real", "2026-01-01").collect()


def test_rewrite_drops_stale_days_and_windows_keep_them(spark):
    path = scratch_path(spark, "t-rewrite")
    two = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "x int, day string")
    for conf in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", conf)
        catalog.write_table(two, path, ["day"])
        catalog.write_table(two.filter("x = 2"), path, ["day"])
        assert [r.x for r in spark.read.parquet(path).collect()] == [2]
        catalog.write_table(two.filter("x = 1"), path, ["day"], replace_days_only=True)
        assert spark.read.parquet(path).count() == 2
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_inventory_of_nothing(spark, tmp_path):
    assert landing.inventory(spark, str(tmp_path), "cen", "2026-01-01").count() == 0


def test_stored_tables_need_a_bound(spark):
    with pytest.raises(catalog.MissingTimeFilter):
        StoredRawTables(spark, "/nonexistent")
    with pytest.raises(catalog.MissingTimeFilter):
        StoredRawTables(spark, "/nonexistent", start="2024-01-01 00:00:00")
    with pytest.raises(ValueError, match="whole days"):
        StoredRawTables(spark, "/nonexistent", "2024-01-01 06:00:00", "2024-01-02 00:00:00")


def test_windowed_run_agrees_with_a_full_one(spark):
    root = scratch_path(spark, "t-window")
    src = raw_tables(spark, SF_SMALL)
    for table in ("generacion_real", "era5_solar", "centrales_info"):
        s, df = catalog.SOURCES[table], getattr(src, table)
        if s.partition_column:
            df = df.withColumn(s.partition_column, F.to_date(s.time_column))
        catalog.write_table(df, f"{root}/raw/{table}", [s.partition_column] if s.partition_column else [])
    clock = "2026-06-01 00:00:00"
    whole = StoredRawTables(spark, f"{root}/raw", as_of=clock)
    for raw in (whole, StoredRawTables(spark, f"{root}/raw", "2024-04-03 00:00:00", "2024-04-05 00:00:00")):
        plan = raw.generacion_real._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(fecha_part" in plan
    Models(spark, whole, clock, clock).materialize(f"{root}/full")
    Models(spark, whole, clock, clock).materialize(f"{root}/both")
    window = StoredRawTables(spark, f"{root}/raw", "2024-04-03 00:00:00", "2024-04-05 00:00:00")
    Models(spark, window, clock, clock).materialize(f"{root}/both")
    for n in ("fact_hourly", "daily_by_plant", "daily_by_technology", "system_summary", "plant_efficiency",
              "training_solar", "stg_generation"):
        a, b = (spark.read.parquet(f"{root}/{r}/{n}") for r in ("full", "both"))
        assert a.count() == b.count() > 0 and a.exceptAll(b.select(a.columns)).isEmpty(), n


def test_scan_requires_time_range(spark):
    with pytest.raises(catalog.MissingTimeFilter):
        catalog.scan_day_partitioned(spark, "/nonexistent", "fecha_hora", None, "2024-01-01")


def test_landing_roundtrip_small(spark):
    root = scratch_path(spark, "t-landing")
    df = spark.createDataFrame([(1, 2.5, "2024-01-01 03:00:00")], "id_central long, gen_real_mw double, f string") \
        .select("id_central", "gen_real_mw", F.col("f").cast("timestamp_ntz").alias("fecha_hora"))
    landing.write_landing(df, root, "cen", "generacion-real_v3", "2026-01-01", "2026-01-01 05:00:00")
    back = landing.read_landing(spark, root, "generacion_real", "2026-01-01").first()
    assert back.gen_real_mw == 2.5 and str(back._extracted_at) == "2026-01-01 05:00:00"
    assert str(back.fecha_hora) == "2024-01-01 03:00:00"


def test_models_from_loaded_landing(spark):
    """Landed JSONL for all four sources -> raw tables -> models from storage."""
    from conftest import SF_SMALL
    from vatio.plans.pipeline import Models
    from vatio.sources.stored import StoredRawTables
    from vatio.sources.testdata import raw_tables
    src = raw_tables(spark, SF_SMALL)
    root = scratch_path(spark, "t-stored")
    raw_root = f"{root}/raw"
    for table, source, entity in [("generacion_real", "cen", "generacion-real_v3_findByDate"),
                                  ("centrales_info", "cen", "centrales_v4_findByDate"),
                                  ("era5_solar", "era5", "era5_grid_solar"),
                                  ("era5_wind", "era5", "era5_grid_wind")]:
        df = getattr(src, table)
        landing.write_landing(df, root, source, entity, "2026-06-01", "2026-06-01 00:00:00")
        out = landing.load_landing(spark, root, table, "2026-06-01", f"{raw_root}/{table}")
        assert out.count() == df.count()
    stored = Models(spark, StoredRawTables(spark, raw_root, as_of="2026-06-01 00:00:00"))
    direct = Models(spark, src)
    assert stored.stg_generation.count() == direct.stg_generation.count()
    assert stored.system_summary.count() == direct.system_summary.count()
    assert stored.training_solar.count() == direct.training_solar.count()
    windowed = StoredRawTables(spark, raw_root, "2024-04-01 00:00:00", "2024-04-03 00:00:00")
    days = {r.d for r in windowed.generacion_real.select(F.to_date("fecha_hora").alias("d")).distinct().collect()}
    assert days and all(str(d) in ("2024-04-01", "2024-04-02") for d in days)


def test_audit_per_series(spark, tmp_path):
    schema = GENERATION.__class__([f for f in GENERATION.fields if f.name == "id_central"])
    for series, n in (("a", 5), ("b", 3)):
        d = tmp_path / series
        d.mkdir()
        rows = [{"id_central": i} for i in range(n)]
        (d / "p1.json").write_text(json.dumps({"data": rows[:2], "totalCount": n, "page": 1}))
        (d / "p2.json").write_text(json.dumps({"data": rows[2:4], "totalCount": n, "page": 2}))
    got = {r.series.rsplit("/", 1)[-1]: r for r in
           landing.audit_pages(landing.read_pages(spark, str(tmp_path) + "/*", schema), 2, by_series=True,
                               max_pages=2).collect()}
    assert got["a"].rows == 4 and got["a"].expected_pages == 3 and not got["a"].complete
    assert got["b"].rows == 3 and got["b"].complete and got["b"].reached_max_pages


def test_landing_defaults(spark):
    from datetime import UTC, datetime
    root = scratch_path(spark, "t-landing-now")
    df = spark.createDataFrame([(1,)], "id_central long")
    path = landing.write_landing(df, root, "cen", "centrales_v4_findByDate")
    today = datetime.now(UTC).strftime("%Y-%m-%d")
    assert f"/cen/{today}/centrales_v4_findByDate.jsonl" in path
    back = landing.read_landing(spark, root, "centrales_info", today).first()
    assert back.id_central == 1 and back._extracted_at is not None


def test_landed_files_are_packed_and_bounded(spark, monkeypatch):
    """A landed batch is gzip, in files of a bounded number of rows, and loads whole."""
    monkeypatch.setattr(landing, "RECORDS_PER_FILE", 40)
    root = scratch_path(spark, "t-packed")
    rows = spark.range(100, numPartitions=1).selectExpr("id AS id_opreal", "id % 7 AS id_central",
                                                        "timestamp_ntz'2024-04-01 00:00:00' AS fecha_hora",
                                                        "timestamp_ntz'2024-04-01 00:00:00' AS _extracted_at")
    path = landing.write_landing(rows, root, "cen", "generacion-real_v3", "2026-06-01", "2026-06-01 01:00:00")
    files = [os.path.basename(f) for f in spark.read.text(path).inputFiles()]
    assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)
    back = landing.read_landing(spark, root, "generacion_real", "2026-06-01")
    assert sorted(r.id_opreal for r in back.collect()) == list(range(100))
    assert landing.inventory(spark, root, "cen", "2026-06-01").select("files", "lines").first() == (3, 100)


def test_pages_are_packed_and_not_shuffled(spark):
    """the text of pages stays in the tasks that read it."""
    rows = spark.range(100).selectExpr("id * 1000 AS id_opreal", "CAST(id AS double) AS gen_real_mw")
    path = testdata_files.write_pages(rows)
    assert all(f.endswith(".gz") for f in spark.read.text(path).inputFiles())
    schema = GENERATION.__class__([f for f in GENERATION.fields if f.name in rows.columns])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = landing.read_pages(spark, path, schema)
        assert "SortMergeJoin" not in pages._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.row.id_opreal for r in pages.collect()) == [i * 1000 for i in range(100)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rows_of_a_day_table_are_written_where_they_lie(spark):
    """a table made row by row from one of the same days is not shuffled; the days stay whole."""
    source, path, seen = scratch_path(spark, "t-days"), scratch_path(spark, "t-dealt"), []
    rows = spark.createDataFrame([(i, f"2024-01-0{1 + i % 3}") for i in range(30)], "x int, day string")
    catalog.write_table(rows, source, ["day"])
    catalog.write_table(spark.read.parquet(source).filter("x > 4"), path, ["day"], dealt=True,
                        watch=lambda d: seen.append(d) or d)
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.x, str(r.day)) for r in spark.read.parquet(path).collect()) == \
        sorted((r.x, r.day) for r in rows.collect() if r.x > 4)


@pytest.mark.parametrize("names", [["stg_generation", "plants_geo", "generation_enriched", "fact_hourly"],
                                   ["plants_geo", "generation_enriched", "fact_hourly"]])
def test_hourly_models_are_dealt_out_once(spark, monkeypatch, names):
    """Of the hourly models only the first is dealt out by day."""
    plain, dealt = catalog.write_table, {}

    def write(df, path, *args, **options):
        dealt[path.rsplit("/", 1)[1]] = options.get("dealt", False)
        plain(df, path, *args, **options)

    monkeypatch.setattr(catalog, "write_table", write)
    m = Models.from_testdata(spark, SF_SMALL).materialize(scratch_path(spark, "t-once"), names)
    assert dealt["generation_enriched"] and dealt["fact_hourly"] and not dealt["plants_geo"]
    lazy = Models.from_testdata(spark, SF_SMALL).fact_hourly
    assert m.fact_hourly.select(lazy.columns).exceptAll(lazy).isEmpty() and m.fact_hourly.count() == lazy.count()


@pytest.mark.parametrize("names", [["stg_generation", "plants_geo", "generation_enriched", "fact_hourly"],
                                   ["plants_geo", "generation_enriched"]])
def test_hourly_rows_are_sorted_before_they_are_widened(spark, monkeypatch, names):
    """the write of rows joined to their plant sorts none of them: they were sorted by day while narrow."""
    plain, plans = catalog.write_table, {}

    def write(df, path, *args, **options):
        def watch(out):
            plans[path.rsplit("/", 1)[1]] = out._jdf.queryExecution().executedPlan().toString()
            return out
        plain(df, path, *args, **options | {"watch": watch})

    monkeypatch.setattr(catalog, "write_table", write)
    m = Models.from_testdata(spark, SF_SMALL).materialize(scratch_path(spark, "t-sorted"), names)
    for name in names[names.index("generation_enriched"):]:
        before, after = plans[name].split("BroadcastHashJoin", 1)
        assert "Sort " not in before and "Sort " in after
    lazy = Models.from_testdata(spark, SF_SMALL).generation_enriched
    got = m.generation_enriched.select(lazy.columns)
    assert got.exceptAll(lazy).isEmpty() and got.count() == lazy.count()


def test_training_set_after_a_run_reads_the_buckets(spark):
    """The training set that a run did not write is joined from its stored sides, with no shuffle."""
    names = ["stg_generation", "stg_plants", "stg_era5_solar", "plants_geo", "era5_cells", "era5_features",
             "generation_enriched", "solar_target"]
    m = Models.from_testdata(spark, SF_SMALL).materialize(scratch_path(spark, "t-sides"), names)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = m.training_solar._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lazy = Models.from_testdata(spark, SF_SMALL).training_solar
    assert m.training_solar.exceptAll(lazy).isEmpty() and m.training_solar.count() == lazy.count()
