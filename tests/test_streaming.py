"""Incremental file-stream loading: each landed file is appended exactly once."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vatio.session import scratch_path
from vatio.sources import landing, testdata
from vatio.sources.catalog import SOURCES, write_table
from vatio.streaming import stream_landing
from vatio.streaming.landing_stream import append_once


def test_incremental_exactly_once(spark):
    raw = testdata.raw_generacion(spark, SF_SMALL)
    root = scratch_path(spark, "t-stream")
    table, ckpt = f"{root}/raw/generacion_real", f"{root}/_ck"
    first = raw.filter(F.col("hora") <= 12)
    second = raw.filter(F.col("hora") > 12)

    def run():
        stream_landing(spark, root, "generacion_real", table, ckpt).awaitTermination()
        return spark.read.parquet(table)

    landing.write_landing(first, root, "cen", "generacion-real_v3_findByDate", "2026-06-01", "2026-06-01 01:00:00")
    assert run().count() == first.count()
    landing.write_landing(second, root, "cen", "generacion-real_v3_findByDate", "2026-06-02", "2026-06-02 01:00:00")
    assert run().count() == raw.count()
    out = run()                                           # nothing new: no duplicates
    assert out.count() == raw.count()
    stamps = {r[0] for r in out.select(F.date_format("_extracted_at", "yyyy-MM-dd")).distinct().collect()}
    assert stamps == {"2026-06-01", "2026-06-02"}
    assert "fecha_part" in out.columns


def test_replayed_batch_appends_what_is_missing(spark):
    src = SOURCES["generacion_real"]
    rows = testdata.raw_generacion(spark, SF_SMALL).withColumn("fecha_part", F.to_date("fecha_hora"))
    root = scratch_path(spark, "t-replay")
    table = f"{root}/table"
    write_table(rows.filter("hora <= 6"), table, ["fecha_part"], mode="append")   # a crash left part of the batch
    spark.range(1).write.json(f"{root}/marks/0/begun")
    for _ in range(2):
        append_once(rows, f"{root}/marks/0", table, src)
        assert spark.read.parquet(table).count() == rows.count()


def test_batch_and_stream_share_a_table(spark):
    raw = testdata.raw_generacion(spark, SF_SMALL)
    root = scratch_path(spark, "t-mixed")
    table = f"{root}/table"
    name = "generacion-real_v3_findByDate"
    landing.write_landing(raw, f"{root}/a", "cen", name, "2026-06-01", "2026-06-01 01:00:00")
    landing.write_landing(raw.limit(10), f"{root}/b", "cen", name, "2026-06-02", "2026-06-02 01:00:00")
    n = raw.count()
    assert landing.load_landing(spark, f"{root}/a", "generacion_real", "2026-06-01", table).count() == n
    stream_landing(spark, f"{root}/b", "generacion_real", table, f"{root}/_ck").awaitTermination()
    assert spark.read.parquet(table).count() == n + 10
    assert landing.load_landing(spark, f"{root}/a", "generacion_real", "2026-06-01", table).count() == 2 * n + 10


def test_page_files_are_taken_in_so_many_batches_at_any_number(spark, tmp_path):
    """F1: the number of micro-batches does not grow with the page files."""
    from vatio.streaming import files_per_trigger
    for i in range(30):
        (tmp_path / f"{i}.txt").write_text("{}")
    assert files_per_trigger(spark, str(tmp_path)) == 8
    assert files_per_trigger(spark, str(tmp_path), batches=3) == 10
