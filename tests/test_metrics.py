import pytest
from pyspark.sql import functions as F

from vatio.operators.metrics import query_metrics


def test_multi_model_metrics_join(models):
    tables = {"system_summary": models.system_summary, "daily_by_technology": models.daily_by_technology}
    df = query_metrics(tables, ["generacion_sistema_total", "generacion_diaria_total"], grain="day")
    assert set(df.columns) == {"metric_time", "generacion_sistema_total", "generacion_diaria_total"}
    assert df.count() == models.system_summary.count()
    monthly = query_metrics(tables, ["generacion_sistema_total"], grain="month")
    assert monthly.agg(F.sum("generacion_sistema_total")).first()[0] == \
        models.system_summary.agg(F.sum("generacion_total_mwh")).first()[0]


def test_unknown_dimension(models):
    with pytest.raises(ValueError):
        query_metrics({"system_summary": models.system_summary}, ["generacion_sistema_total"], ["region"])


def test_where_and_dimension(models):
    df = query_metrics({"fact_hourly": models.fact_hourly}, ["generacion"], ["tipo_tecnologia"],
                       where=F.col("region") == "AMERICA")
    total = models.fact_hourly.filter("region = 'AMERICA'").agg(F.sum("generacion_real_mw")).first()[0]
    assert df.agg(F.sum("generacion")).first()[0] == total


def test_global_metrics_from_two_models(models):
    tables = {"system_summary": models.system_summary, "daily_by_technology": models.daily_by_technology}
    row = query_metrics(tables, ["generacion_sistema_total", "generacion_diaria_total"]).first()
    assert row.generacion_sistema_total >= row.generacion_diaria_total > 0


def test_entity_dimension(models):
    tables = {"fact_hourly": models.fact_hourly, "plants_geo": models.plants_geo}
    df = query_metrics(tables, ["generacion"], ["central__tipo_tecnologia"])
    assert df.agg(F.sum("generacion")).first()[0] == models.fact_hourly.agg(F.sum("generacion_real_mw")).first()[0]
    with pytest.raises(ValueError):
        query_metrics({"system_summary": models.system_summary}, ["generacion_sistema_total"], ["central__region"])
