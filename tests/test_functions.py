"""Scalar functions: golden values and edge cases."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vatio.functions import (classify_source, cyclic, decimal_comma, dt_part, entity_name,
                             grid_snap, haversine_m, leading_int, local_hour_to_utc,
                             local_midnight_utc, precision_category, round_half_away,
                             safe_divide, state_tag, strip_tags)
from vatio.functions.energy import direct_fraction, fraction_to_pct, kelvin_to_celsius, \
    per_hour_energy_to_power
from vatio.functions.geo import with_utm_latlon


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_decimal_comma(spark):
    got = one(spark, decimal_comma("x"), [("61,5",), ("1.234,5",), ("",), ("Sin información",), (None,), ("0",)], "x string")
    assert got == [61.5, None, None, None, None, 0.0]
    assert one(spark, decimal_comma("x"), [(12.0,)], "x double") == [12.0]


def test_tags(spark):
    df = spark.createDataFrame([("Foo [EN_REVISION]",), ("Foo",), ("[A] Bar [B]",), (None,)], "x string")
    rows = df.select(strip_tags("x"), state_tag("x")).collect()
    assert [tuple(r) for r in rows] == [("Foo", "en_revision"), ("Foo", "normal"), ("Bar", "a"), (None, "normal")]


def test_leading_int_and_entity(spark):
    assert one(spark, leading_int("x"), [("19G",), ("x",), ("",), (None,)], "x string") == [19, None, None, None]
    assert one(spark, entity_name("x"), [("/generacion-real/v3/findByDate/",)], "x string") == \
        ["generacion-real_v3_findByDate"]


@pytest.mark.parametrize("day,expected", [
    ("2024-01-15", datetime(2024, 1, 15, 3)), ("2024-07-15", datetime(2024, 7, 15, 4)),
    ("2024-09-08", datetime(2024, 9, 8, 4)), ("2024-04-07", datetime(2024, 4, 7, 4))])
def test_local_midnight(spark, day, expected):
    got = one(spark, local_midnight_utc(F.col("d").cast("timestamp_ntz")), [(day,)], "d string")
    assert got == [expected]


def test_hour_collision_on_short_day(spark):
    df = spark.createDataFrame([("2024-09-08 23:00:00", 24), ("2024-09-09 00:00:00", 1), ("2024-09-09 00:00:00", None)],
                               "t string, h long")
    got = [r[0] for r in df.select(local_hour_to_utc(F.col("t").cast("timestamp_ntz"), "h")).collect()]
    assert got == [datetime(2024, 9, 9, 3), datetime(2024, 9, 9, 3), None]


def test_session_zone_does_not_matter(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = one(spark, local_hour_to_utc(F.col("t").cast("timestamp_ntz"), F.lit(5)), [("2024-01-15 00:00:00",)], "t string")
        assert got == [datetime(2024, 1, 15, 7)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parts(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7, 13),)], "t timestamp_ntz")
    r = df.select(dt_part("dayofweek", "t"), dt_part("hour", "t"), dt_part("month", "t"), dt_part("year", "t")).first()
    assert tuple(r) == (1, 13, 1, 2024)
    assert dict(df.select(dt_part("hour", "t").alias("h")).dtypes)["h"] == "bigint"


def test_classification(spark):
    got = one(spark, classify_source("x"), [("Eolica",), ("Eólica",), (None,), ("Solar",), ("Biogás",)], "x string")
    assert got == ["Renovable", "Convencional", "Convencional", "Renovable", "Renovable"]


def test_cyclic_and_features(spark):
    df = spark.createDataFrame([(6, 300.0, 3600000.0, 0.5, 0.0, 10.0)], "h int, t2m double, ssrd double, tcc double, z double, f double")
    r = df.select(cyclic("h", 24, "cos"), cyclic("h", 24, "sin"), kelvin_to_celsius("t2m"),
                  per_hour_energy_to_power("ssrd"), fraction_to_pct("tcc"), direct_fraction("f", "z")).first()
    assert tuple(r) == (0.0, 1.0, 26.85, 1000.0, 50.0, None)


def test_rounding_and_divide(spark):
    df = spark.createDataFrame([(2.675, -2.5, 1.0, 0.0)], "a double, b double, c double, z double")
    r = df.select(round_half_away("a", 2), round_half_away("b", 0), safe_divide("c", "z"), safe_divide("z", "z")).first()
    assert tuple(r) == (2.68, -3.0, None, None)  # 2.675 * 100 is exactly 267.5 as a double


def test_grid_snap_halves_away(spark):
    got = one(spark, grid_snap("x"), [(-33.375,), (-33.374,), (-33.376,), (-133.5 / 4,)], "x double")
    assert got == [-33.5, -33.25, -33.5, -33.5]


GOLDEN_UTM = [
    ((345713.154, 6297592.028, 19), (-33.45, -70.66)),
    ((500000.000, 7401128.625, 19), (-23.5, -69.0)),
    ((666929.738, 5403804.833, 18), (-41.5, -73.0)),
    ((372791.588, 4114918.245, 19), (-53.1, -70.9)),
]


def test_utm_golden(spark):
    df = spark.createDataFrame([(e, n, z) for (e, n, z), _ in GOLDEN_UTM] + [(None, 1.0, 19), (1.0, 1.0, None)],
                               "e double, n double, z long")
    rows = with_utm_latlon(df, "e", "n", "z").select("coords").collect()
    for (_, (lat, lon)), r in zip(GOLDEN_UTM, rows):
        # golden inputs are given to the millimetre: agreement within ~1 mm (1e-8 deg)
        assert abs(r.coords.latitude - lat) < 2e-8 and abs(r.coords.longitude - lon) < 2e-8
    assert rows[-1].coords is None and rows[-2].coords is None


def test_distance_and_category(spark):
    df = spark.createDataFrame([(-33.45, -70.66, -33.5, -70.75)], "a double, b double, c double, d double")
    d = df.select(haversine_m("a", "b", "c", "d").alias("d")).first().d
    assert round(d, 2) == pytest.approx(10029.60, abs=0.02)
    cats = one(spark, precision_category("x"), [(999.9,), (1000.0,), (5000.0,), (14999.0,), (15000.0,), (None,)], "x double")
    assert cats == ["Perfecta", "Excelente", "Buena", "Regular", "Mala", "Mala"]


def test_sql_functions(spark):
    from vatio.functions.sql import register_sql_functions
    register_sql_functions(spark)
    r = spark.sql("SELECT clasificar_fuente('Eolica') a, clasificar_fuente(NULL) b, decimal_comma('61,5') c, "
                  "safe_divide(1.0, 0.0) d").first()
    assert tuple(r) == ("Renovable", "Convencional", 61.5, None)


def test_views(spark, models):
    from vatio.sources.catalog import register_views
    register_views({"sys_summary": models.system_summary})
    assert spark.sql("SELECT count(*) FROM sys_summary").first()[0] == models.system_summary.count()
