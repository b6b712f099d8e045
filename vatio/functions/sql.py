"""SQL functions for SQL users (J3): temporary SQL UDFs whose bodies are
plain SQL expressions, so they inline into the plan like built-ins."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import geo
from .energy import RENEWABLE_TECHNOLOGIES
from .text import NUMBER


def _series(terms, shape: str) -> str:
    return "".join(f" + {float(t)!r}D * " + shape.format(k=f"{2.0 * j}D") for j, t in enumerate(terms, 1))


def _utm_body() -> str:
    """The projection of functions.geo as one nested SELECT over its arguments."""
    minus = [-b for b in geo.BETA]
    turn = "180.0D / pi()"
    half = 10.0 ** geo.LATLON_DIGITS
    rounded = f"round({{x}} * {half!r}D) / {half!r}D"
    return f"""SELECT struct({rounded.format(x=f'(chi{_series(geo.DELTA, "sin({k} * chi)")}) * {turn}')} AS latitude,
          {rounded.format(x=f'((zone * 6.0D - 183.0D) * pi() / 180.0D + atan2(sinh(et), cos(xt))) * {turn}')} AS longitude)
        FROM (SELECT *, asin(sin(xt) / cosh(et)) AS chi FROM (
          SELECT *, xi{_series(minus, "sin({k} * xi) * cosh({k} * eta)")} AS xt,
                 eta{_series(minus, "cos({k} * xi) * sinh({k} * eta)")} AS et FROM (
          SELECT (north - {geo.FALSE_NORTHING_SOUTH!r}D) / {geo._SCALE!r}D AS xi,
                 (east - {geo.FALSE_EASTING!r}D) / {geo._SCALE!r}D AS eta)))"""


def register_sql_functions(spark: SparkSession) -> None:
    renewables = ", ".join("'" + t.replace("'", "''") + "'" for t in RENEWABLE_TECHNOLOGIES)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION clasificar_fuente(tipo STRING)
        RETURNS STRING RETURN CASE WHEN tipo IN ({renewables}) THEN 'Renovable' ELSE 'Convencional' END""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION decimal_comma(x STRING) RETURNS DOUBLE
        RETURN CASE WHEN regexp_like(replace(x, ',', '.'), r'{NUMBER}')
                    THEN try_cast(replace(x, ',', '.') AS DOUBLE) END""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION utm_to_latlon(east DOUBLE, north DOUBLE, zone BIGINT)
        RETURNS STRUCT<latitude: DOUBLE, longitude: DOUBLE> RETURN ({_utm_body()})""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION safe_divide(a DOUBLE, b DOUBLE)
        RETURNS DOUBLE RETURN try_divide(a, b)""")
