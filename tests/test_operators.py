"""Operators against brute force on small inputs."""

from datetime import datetime

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from vatio.operators import (broadcast_if_small, forward_fill, latest_per_key, peak_valley,
                             sum_of_member_max, top1_per_group)


def _key(row):
    return tuple((v is None, v) for v in row)


def test_latest_per_key_matches_window(spark):
    rows = [(1, "a", 3, "x"), (1, "a", 3, "y"), (1, "a", None, "z"), (1, "b", 1, "q"),
            (None, "a", 2, "n1"), (None, "a", 5, "n2"), (2, None, 1, "p")]
    df = spark.createDataFrame(rows, "k long, k2 string, t long, v string")
    got = sorted((tuple(r) for r in latest_per_key(df, ["k", "k2"], ["t"]).select("k", "k2", "t", "v").collect()),
                 key=_key)
    w = Window.partitionBy("k", "k2").orderBy(F.desc_nulls_last("t"), F.desc_nulls_last("v"))
    ref = sorted((tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
                  .select("k", "k2", "t", "v").collect()), key=_key)
    assert got == ref
    assert (1, "a", 3, "y") in got and (None, "a", 5, "n2") in got


def test_latest_is_idempotent(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k long, t long, v string")
    once = latest_per_key(df, ["k"], ["t"])
    twice = latest_per_key(once, ["k"], ["t"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_top1_ties_and_nulls(spark):
    df = spark.createDataFrame([("d1", "B", 10.0), ("d1", "A", 10.0), ("d1", "C", None), ("d2", "X", None),
                                ("d3", None, 5.0), ("d3", "Z", 5.0)], "g string, t string, v double")
    got = {r.g: r.t for r in top1_per_group(df, ["g"], "v", ["t"], ["t"]).collect()}
    assert got == {"d1": "A", "d2": "X", "d3": None}


def test_forward_fill_matches_window(spark):
    data = []
    for key in (1, 2):
        for h in range(0, 72, 5):
            val = None if (h // 5) % 3 else float(h + key)
            data.append((key, datetime(2024, 1, 1) + pd.Timedelta(hours=h), val))
    data.append((3, datetime(2024, 1, 2), None))
    df = spark.createDataFrame(data, "k long, ts timestamp_ntz, v double")
    got = sorted((tuple(r) for r in forward_fill(df, "k", "ts", ["v"]).collect()), key=_key)
    w = Window.partitionBy("k").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    ref = sorted((tuple(r) for r in df.select("k", "ts", F.last("v", ignorenulls=True).over(w).alias("v")).collect()),
                 key=_key)
    assert got == ref


def test_two_level(spark):
    df = spark.createDataFrame([("d", "p1", 1, 5.0, 1.0), ("d", "p1", 2, 7.0, 2.0), ("d", "p2", 1, 3.0, 4.0)],
                               "g string, m string, h long, cap double, v double")
    assert sum_of_member_max(df, ["g"], "m", "cap", "c").first().c == 10.0
    r = peak_valley(df, ["g"], "h", "v", "mx", "mn").first()
    assert (r.mx, r.mn) == (5.0, 2.0)


def test_broadcast_check(spark):
    small, big = spark.range(10), spark.range(100)
    assert broadcast_if_small(big, 1000) is big        # over the cap in bytes: left to the planner
    hinted = broadcast_if_small(small, 1000)
    assert hinted is not small
    joined = spark.range(1000).join(hinted, "id")
    assert sorted(r.id for r in joined.collect()) == list(range(10))


def test_both_ways_of_a_dimension_join(spark, models, monkeypatch):
    """The shuffled join gives the rows of the broadcast one, in the models too."""
    from vatio.operators import joins
    from vatio.plans.pipeline import RUN_TS, Models
    broadcast = models.daily_by_plant
    assert models.plants_small
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 0)
    shuffled = Models(spark, models.raw, RUN_TS, RUN_TS)
    assert not shuffled.plants_small
    other = shuffled.daily_by_plant
    assert other.count() == broadcast.count() and other.exceptAll(broadcast).isEmpty()


def test_run_clock_defaults_to_now(spark):
    from types import SimpleNamespace

    from vatio.plans.pipeline import Models
    from vatio.sources import testdata
    raw = testdata.raw_generacion(spark, "/root/testdata/sf0.001")
    later = raw.withColumn("fecha_hora", raw["fecha_hora"] + F.expr("INTERVAL 700 DAYS"))
    future = raw.withColumn("fecha_hora", raw["fecha_hora"] + F.expr("INTERVAL 7000 DAYS"))
    count = lambda df: Models(spark, SimpleNamespace(generacion_real=df)).stg_generation.count()
    assert count(later) > 0 and count(future) == 0
