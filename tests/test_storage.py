"""Written tables: clustering, buckets, stored partials, observed row checks,
tables of a schema, the guarded scan, streamed archives and page state."""

import json
import subprocess
import sys
import zipfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vatio.operators.quality import ROW_KINDS, run_checks
from vatio.plans import pipeline
from vatio.plans.pipeline import MODEL_ORDER, RUN_TS, Models, run_pipeline
from vatio.plans.tests_declared import CHECKS
from vatio.schemas import ERA5_PRESET_COLUMNS, GENERATION
from vatio.session import scratch_path
from vatio.sources import catalog, era5, landing, testdata
from vatio.sources.guarded import register_guarded
from vatio.sources.stored import StoredRawTables
from vatio.streaming import latest_audit, series_verdicts, stream_audit


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark):
    """The raw tables on storage, by the loaders' write."""
    root = scratch_path(spark, "t-raw")
    src = testdata.raw_tables(spark, SF_SMALL)
    for table in ("generacion_real", "era5_solar", "centrales_info"):
        s, df = catalog.SOURCES[table], getattr(src, table)
        if s.partition_column:
            df = df.withColumn(s.partition_column, F.to_date(s.time_column))
        catalog.write_table(df, f"{root}/{table}", [s.partition_column] if s.partition_column else [], s.cluster_by)
    return root


# ---- clustering ----------------------------------------------------------------

def test_files_of_a_day_hold_disjoint_ranges(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") * 7919 % 1000).alias("id_central"), (F.col("id") % 2).alias("day"),
                                      F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("v"))
    # A hot key: a third of the rows of a day is one plant.
    rows = rows.withColumn("id_central", F.when(F.col("v") == 5, F.lit(400)).otherwise(F.col("id_central")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        catalog.write_table(rows, str(tmp_path / "t"), ["day"], ["id_central"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for day in (0, 1):
        files = sorted((tmp_path / "t" / f"day={day}").glob("*.parquet"))
        assert len(files) > 2
        spans, largest = [], 0
        for f in files:
            meta = pq.ParquetFile(f).metadata
            groups = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
            spans.append((min(g.min for g in groups), max(g.max for g in groups)))
            largest = max(largest, meta.num_rows)
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert largest < 14_000                       # the hot plant is in several files
        groups = sum(a <= 37 <= b for a, b in spans)
        assert groups == 1 < len(spans)               # a filter on a plant skips the others
    found = spark.read.parquet(str(tmp_path / "t"))
    assert found.exceptAll(rows.select(found.columns)).isEmpty() and found.count() == 40_000


# ---- buckets -------------------------------------------------------------------

def test_training_join_of_stored_sides_shuffles_nothing(spark, models):
    root = scratch_path(spark, "t-buckets")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = ["stg_plants", "stg_era5_solar", "plants_geo", "era5_cells", "era5_features", "generation_enriched",
                 "solar_target"]
        m = Models(spark, models.raw, RUN_TS, RUN_TS).materialize(root, names)
        target, features = (catalog.bucketed_table(spark, f"{root}/{n}") for n in ("solar_target", "era5_features"))
        from vatio.plans import marts
        joined = marts.training_solar(target, features)
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert joined.count() == models.training_solar.count() > 0
        assert joined.exceptAll(models.training_solar).isEmpty()
        assert set(m.solar_target.columns) == set(models.solar_target.columns)
        # Read as files, the tables are what they were.
        assert spark.read.parquet(f"{root}/solar_target").count() == models.solar_target.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_days_are_replaced_alone(spark):
    path = scratch_path(spark, "t-bucket-days")
    rows = spark.range(100).select("id", (F.col("id") % 4).alias("day"), F.lit("old").alias("v"))
    catalog.write_bucketed(rows, path, (4, ["id"]), "day")
    new = rows.filter("day = 2").withColumn("v", F.lit("new"))
    catalog.write_bucketed(new, path, (4, ["id"]), "day", replace_days_only=True)
    for t in (catalog.bucketed_table(spark, path), spark.read.parquet(path)):
        assert {(r.v, r.day): r.n for r in t.groupBy("v", "day").agg(F.count("*").alias("n")).collect()} \
            == {("old", 0): 25, ("old", 1): 25, ("old", 3): 25, ("new", 2): 25}
    catalog.write_bucketed(new, path, (4, ["id"]), "day")
    assert spark.read.parquet(path).count() == 25


# ---- plans ---------------------------------------------------------------------

def test_no_text_aggregate_over_hours(models):
    """Only the rows of a day and plant that differ in technology meet a sort aggregate."""
    plan = plan_of(models.daily_by_plant)
    keys = [line for line in plan.splitlines() if "SortAggregate" in line and "fecha" in line]
    assert keys and all("min(tipo_tecnologia" in line and "sum(mwh" in line for line in keys)


def test_lifetime_figures_of_a_window_read_no_hour_outside_it(spark, stored, monkeypatch):
    root = scratch_path(spark, "t-partials")
    whole = StoredRawTables(spark, stored, as_of=RUN_TS)
    Models(spark, whole, RUN_TS, RUN_TS).materialize(root)
    full = {r.id_central: r for r in spark.read.parquet(f"{root}/plant_efficiency").collect()}
    seen = {}
    window = StoredRawTables(spark, stored, "2024-04-03 00:00:00", "2024-04-05 00:00:00")
    m = Models(spark, window, RUN_TS, RUN_TS)
    from vatio.plans import marts
    built = marts.plant_efficiency

    def watched(*args, **kw):
        out = built(*args, **kw)
        seen["files"] = out.inputFiles()
        return out

    monkeypatch.setattr(pipeline.marts, "plant_efficiency", watched)
    m.materialize(root)
    assert {f.removeprefix("file://").removeprefix("file:").split(root.removeprefix("file:"))[1].split("/")[1] for f in seen["files"]} == {"plant_days", "plants_geo"}
    again = {r.id_central: r for r in spark.read.parquet(f"{root}/plant_efficiency").collect()}
    assert again == full and full


# ---- row checks ----------------------------------------------------------------

def test_row_checks_are_counted_by_the_write(spark, monkeypatch):
    """Every row-level test has its failures from the write, equal to a count of the table."""
    root = scratch_path(spark, "t-observed")
    raw = testdata.raw_tables(spark, SF_SMALL)
    from vatio.operators import quality
    scanned = []
    real = quality._model_failures
    monkeypatch.setattr(quality, "_model_failures", lambda df, cs: scanned.extend(cs) or real(df, cs))
    results = {r.test_id: (r.failures, r.status) for r in run_pipeline(spark, raw, root, RUN_TS).collect()}
    assert scanned and not [c for c in scanned if c.kind in ROW_KINDS]
    tables = {n: spark.read.parquet(f"{root}/{n}") for n in MODEL_ORDER}
    again = {r.test_id: (r.failures, r.status) for r in run_checks(tables, CHECKS).collect()}
    assert results == again and len(results) == 82
    assert any(f for f, _ in results.values())


def test_window_does_not_count_half_tables(spark, stored):
    root = scratch_path(spark, "t-observed-window")
    whole = StoredRawTables(spark, stored, as_of=RUN_TS)
    run_pipeline(spark, whole, root, RUN_TS)
    window = StoredRawTables(spark, stored, "2024-04-03 00:00:00", "2024-04-05 00:00:00")
    got = {r.test_id: r.failures for r in run_pipeline(spark, window, root, RUN_TS).collect()}
    tables = {n: spark.read.parquet(f"{root}/{n}") for n in MODEL_ORDER}
    assert got == {r.test_id: r.failures for r in run_checks(tables, CHECKS).collect()}


def test_changed_input_gets_a_new_verdict(spark, tmp_path):
    import shutil

    from vatio.registry import QUERIES
    for t in ("nation", "region", "supplier", "lineitem"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")     # writable, whatever the mode of the source
    def failures():
        return {r.test_id: r.failures for r in QUERIES["dq_unique"](spark, str(tmp_path)).collect()}
    before = failures()
    assert failures() == before
    t = pq.read_table(tmp_path / "supplier.parquet")
    ids = t.column("s_suppkey").to_pylist()
    pq.write_table(t.filter([i % 5 != 0 for i in ids]), tmp_path / "supplier.parquet")   # no plant has two versions
    assert failures()[67] == 0 < before[67]


# ---- tables of a schema --------------------------------------------------------

def test_models_in_a_named_schema_keep_their_layout(spark, stored):
    root = scratch_path(spark, "t-schema")
    run_pipeline(spark, StoredRawTables(spark, stored, as_of=RUN_TS), root, RUN_TS, schema="marts_test")
    try:
        day = spark.sql("SELECT * FROM marts_test.daily_by_plant WHERE fecha = DATE'2024-04-03'")
        plan = plan_of(day)
        assert "PartitionFilters: [isnotnull(fecha" in plan and "daily_by_plant" in plan
        parts = spark.sql("SHOW PARTITIONS marts_test.daily_by_plant").count()
        files = spark.read.parquet(f"{root}/daily_by_plant")
        assert parts == files.select("fecha").distinct().count() > 1
        assert spark.table("marts_test.daily_by_plant").count() == files.count()
        where = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED marts_test.daily_by_plant").collect()}
        assert where["Location"].rstrip("/").endswith(f"{root}/daily_by_plant")       # no copy
    finally:
        spark.sql("DROP SCHEMA marts_test CASCADE")


# ---- guarded scan --------------------------------------------------------------

def test_guarded_table_refuses_a_scan_without_a_day(spark, stored):
    register_guarded(spark, stored, "generacion_real", "raw_gen_guarded")
    with pytest.raises(Exception, match="a filter on fecha_part or fecha_hora is required"):
        spark.table("raw_gen_guarded").collect()
    with pytest.raises(Exception, match="is required"):
        spark.sql("SELECT count(*) FROM raw_gen_guarded WHERE id_central = 7").collect()
    truth = testdata.raw_generacion(spark, SF_SMALL)
    for where in ("fecha_part = DATE'2024-04-03'", "fecha_part BETWEEN DATE'2024-04-03' AND DATE'2024-04-05'",
                  "fecha_part IN (DATE'2024-04-03', DATE'2024-09-02') AND id_central > 5",
                  "fecha_hora >= TIMESTAMP_NTZ'2024-04-03 00:00:00' AND fecha_hora < TIMESTAMP_NTZ'2024-04-04 12:00:00'",
                  "fecha_part < DATE'1999-01-01'"):
        got = spark.sql(f"SELECT * FROM raw_gen_guarded WHERE {where}")
        want = truth.withColumn("fecha_part", F.to_date("fecha_hora")).filter(where)
        assert got.count() == want.count() and got.exceptAll(want.select(got.columns)).isEmpty(), where
    # Folders are chosen by the bound.
    from vatio.sources.guarded import DayTableReader
    from pyspark.sql.datasource import EqualTo
    from datetime import date
    from vatio.session import qualified
    reader = DayTableReader({"path": qualified(spark, f"{stored}/generacion_real"), "day": "fecha_part",
                             "time": "fecha_hora"}, None)
    list(reader.pushFilters([EqualTo(("fecha_part",), date(2024, 4, 3))]))
    parts = reader.partitions()
    assert parts and {p.day for p in parts} == {date(2024, 4, 3)}


# ---- archives ------------------------------------------------------------------

def test_archives_over_several_members_and_chunks(spark, tmp_path, monkeypatch):
    cols = ERA5_PRESET_COLUMNS["wind"]
    line = lambda i: ",".join([f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00", *["1.5"] * (len(cols) - 1)])
    with zipfile.ZipFile(tmp_path / "era5_lat1.0_lon2.0_wind_2024.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("notes.txt", "x")
        for part in (0, 1):
            z.writestr(f"{part}.csv", "\n".join([",".join(cols), *map(line, range(part * 100, part * 100 + 100))]))
    for streamed in (True, False):
        got = era5.read_archives(spark, str(tmp_path / "*.zip"), "wind", streamed).collect()
        assert len(got) == 200 == len({r.valid_time for r in got}) and got[0].entity == "era5_lat1.0_lon2.0_wind_2024"
    chunks = list(era5.csv_chunks(open(tmp_path / "era5_lat1.0_lon2.0_wind_2024.zip", "rb"), list(cols), 30))
    assert [len(c) for c in chunks] == [30, 30, 30, 10] * 2


def test_memory_of_an_archive_does_not_grow_with_it(tmp_path):
    """A member of some 400 MB of text is read in a few MB; peak memory of a fresh process tells."""
    cols = ERA5_PRESET_COLUMNS["solar"]
    row = ",".join(["2024-01-01 00:00:00", *["1.25"] * (len(cols) - 1)]) + "\n"
    def archive(rows):
        path = tmp_path / f"{rows}.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z, z.open("a.csv", "w") as f:
            f.write((",".join(cols) + "\n").encode())
            for _ in range(rows // 100_000):
                f.write((row * 100_000).encode())
        return path
    code = ("import resource, sys; from vatio.sources.era5 import csv_chunks, _open; "
            "n = sum(len(c) for c in csv_chunks(_open('file://' + sys.argv[1]), sys.argv[2].split(','))); "
            "print(n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)")
    peaks = {}
    for rows in (200_000, 8_000_000):
        out = subprocess.run([sys.executable, "-c", code, str(archive(rows)), ",".join(cols)], check=True,
                             capture_output=True, text=True).stdout.split()
        assert int(out[0]) == rows
        peaks[rows] = int(out[1])
    assert peaks[8_000_000] < peaks[200_000] + 60, peaks


# ---- pages ---------------------------------------------------------------------

SCHEMA = GENERATION.__class__([f for f in GENERATION.fields if f.name == "id_central"])


def envelope(rows, total, page=None):
    return json.dumps({"data": [{"id_central": i} for i in rows], "totalCount": total} | ({"page": page} if page else {}))


def test_broken_page_fails_the_read_beside_sound_ones(spark, tmp_path):
    (tmp_path / "a.json").write_text(envelope([1], 2) + "\n" + envelope([2], 2)[:-5])
    with pytest.raises(Exception, match="malformed page"):
        landing.read_pages(spark, str(tmp_path), SCHEMA).collect()
    (tmp_path / "a.json").write_text('{"data": [{"id_central": "many"}]}')
    with pytest.raises(Exception, match="malformed page"):
        landing.read_pages(spark, str(tmp_path), SCHEMA).collect()


def test_a_page_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.json").write_text(envelope([1], 2) + "\n" + envelope([2], 2))
    plan = landing.read_pages(spark, str(tmp_path), SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan
    assert max(line.count("from_json") for line in plan.splitlines()) == 1


def test_page_state_equals_the_audit(spark, tmp_path):
    """Pages in any order, over several files and micro-batches, some delivered again."""
    root, out, check = tmp_path / "land", str(tmp_path / "verdicts"), str(tmp_path / "_ck")
    for series in ("whole", "gap", "short", "open", "bare"):
        (root / series).mkdir(parents=True)

    def run():
        stream_audit(spark, f"{root}/*", SCHEMA, 2, out, check, max_files_per_trigger=2).awaitTermination()
        return {r.series.rsplit("/", 1)[-1]: r for r in latest_audit(spark, out).collect()}

    (root / "whole" / "c.json").write_text(envelope([4], 5, 3) + "\n" + envelope([0, 1], 5, 1))
    (root / "gap" / "a.json").write_text(json.dumps(json.loads(envelope([4, 5], 6, 3)), indent=1))
    (root / "open" / "a.json").write_text(json.dumps([{"id_central": 1}, {"id_central": 2}]))
    first = run()
    assert (first["whole"].status, first["whole"].missing) == ("missing", [2])
    assert (first["gap"].status, first["gap"].missing) == ("missing", [1, 2]) and first["open"].status == "open"
    (root / "whole" / "a.json").write_text(envelope([2, 3], 5, 2))
    (root / "gap" / "b.json").write_text(envelope([0, 1], 6, 1))
    (root / "short" / "a.json").write_text(envelope([0], 4, 1))
    (root / "short" / "b.json").write_text(envelope([1, 2], 4, 2))
    (root / "bare" / "a.json").write_text(envelope([0, 1], 3))
    (root / "bare" / "b.json").write_text(envelope([2], 3))
    second = run()
    assert {s: r.status for s, r in second.items()} == {"whole": "complete", "gap": "missing", "short": "short",
                                                        "open": "open", "bare": "complete"}
    audit = landing.audit_pages(landing.read_pages(spark, f"{root}/*", SCHEMA), 2, by_series=True).collect()
    facts = ("pages", "rows", "declared_total", "expected_pages", "short_pages", "empty_pages", "complete")
    assert {r.series.rsplit("/", 1)[-1]: tuple(r[f] for f in facts) for r in audit} \
        == {s: tuple(r[f] for f in facts) for s, r in second.items()}
    (root / "gap" / "c.json").write_text(envelope([2, 3], 6, 2))
    (root / "gap" / "d.json").write_text(envelope([2, 3], 6, 2))       # delivered again
    assert run()["gap"].status == "complete"
    files = spark.read.text(f"{root}/*", wholetext=True)
    batch = series_verdicts(landing.landed_pages(files, SCHEMA), 2)
    assert {r.status for r in batch.collect()} == {"complete", "short", "open"}


# ---- grains --------------------------------------------------------------------

def test_grain_finer_than_the_model_is_refused(models):
    from vatio.operators.metrics import query_metrics
    for name, model in (("generacion_sistema_total", "system_summary"), ("generacion_diaria_total", "daily_by_technology")):
        with pytest.raises(ValueError, match="finer"):
            query_metrics({model: getattr(models, model)}, [name], grain="hour")
    with pytest.raises(ValueError, match="not one of"):
        query_metrics({"fact_hourly": models.fact_hourly}, ["generacion"], grain="minute")
    assert query_metrics({"fact_hourly": models.fact_hourly}, ["generacion"], grain="hour").count() > 0


# ---- scratch -------------------------------------------------------------------

def test_scratch_ends_with_the_application(tmp_path):
    """The driver's folder under the shared one is there while it runs, and gone afterwards."""
    code = ("import sys; from vatio.session import get_session, scratch_path; "
            "s = get_session('local[1]', conf={'spark.checkpoint.dir': sys.argv[1]}); "
            "p = scratch_path(s, 'x'); s.range(3).write.parquet(p); print(s.read.parquet(p).count()); s.stop()")
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path)], check=True, capture_output=True, text=True)
    assert out.stdout.split()[-1] == "3"
    left = [p for p in tmp_path.rglob("*") if "vatio" in p.parts and p.is_file()]
    assert not left
