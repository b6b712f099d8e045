"""Inverse UTM (southern hemisphere), grid cells and sphere distance.

The projection is the Krueger n-series for the inverse transverse Mercator
(Karney 2011, eqs. 6-8 and 15-17 in the inverse direction), written as Column
arithmetic so it runs inside codegen with no Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import as_col
from .numeric import round_half_away

# ---- Fixed values -----------------------------------------------------------
# WGS84 semi-major axis (m) and flattening; UTM scale on the central meridian;
# false easting; false northing of the southern hemisphere.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0
# Mean earth radius used for spherical distances (m).
EARTH_RADIUS_M = 6371010.0
# Decimal places kept of projected degrees (1e-9 deg ~ 0.1 mm; below the
# series error, and makes results identical across SQL engines).
LATLON_DIGITS = 9
# Weather grid step in degrees.
GRID_STEP = 0.25
_N = WGS84_F / (2 - WGS84_F)
_N2, _N3, _N4 = _N ** 2, _N ** 3, _N ** 4
# Rectifying radius and series coefficients (standard Krueger series, order 4).
RECTIFYING_A = WGS84_A / (1 + _N) * (1 + _N2 / 4 + _N4 / 64)
BETA = (
    _N / 2 - 2 / 3 * _N2 + 37 / 96 * _N3 - 1 / 360 * _N4,
    1 / 48 * _N2 + 1 / 15 * _N3 - 437 / 1440 * _N4,
    17 / 480 * _N3 - 37 / 840 * _N4,
    4397 / 161280 * _N4,
)
DELTA = (
    2 * _N - 2 / 3 * _N2 - 2 * _N3,
    7 / 3 * _N2 - 8 / 5 * _N3,
    56 / 15 * _N3,
)
# -----------------------------------------------------------------------------
_SCALE = UTM_K0 * RECTIFYING_A


def _lit(x: float) -> Column:
    return F.lit(float(x))


def _utm_stages(e: Column, n: Column, z: Column) -> list[tuple[str, Column]]:
    """The inverse series as (name, Column) stages; later stages read earlier
    ones by name, so every shared term is evaluated once."""
    stages = [("__xi", (n - _lit(FALSE_NORTHING_SOUTH)) / _lit(_SCALE)),
              ("__eta", (e - _lit(FALSE_EASTING)) / _lit(_SCALE))]
    xi, eta = F.col("__xi"), F.col("__eta")
    xi_p, eta_p = xi, eta
    for j, b in enumerate(BETA, start=1):
        k = _lit(2.0 * j)
        xi_p = xi_p - _lit(b) * F.sin(k * xi) * F.cosh(k * eta)
        eta_p = eta_p - _lit(b) * F.cos(k * xi) * F.sinh(k * eta)
    stages += [("__xi_p", xi_p), ("__eta_p", eta_p)]
    xi_p, eta_p = F.col("__xi_p"), F.col("__eta_p")
    stages.append(("__chi", F.asin(F.sin(xi_p) / F.cosh(eta_p))))
    chi = F.col("__chi")
    phi = chi
    for j, d in enumerate(DELTA, start=1):
        phi = phi + _lit(d) * F.sin(_lit(2.0 * j) * chi)
    lon0 = (z.cast("double") * _lit(6.0) - _lit(183.0)) * _lit(math.pi) / _lit(180.0)
    lam = lon0 + F.atan2(F.sinh(eta_p), F.cos(xi_p))
    stages += [("__lat", phi * _lit(180.0) / _lit(math.pi)),
               ("__lon", lam * _lit(180.0) / _lit(math.pi))]
    return stages


def with_utm_latlon(df: DataFrame, easting: str, northing: str, zone: str,
                    out: str = "coords") -> DataFrame:
    """Add ``out`` = struct<latitude, longitude> from UTM (southern hemisphere).

    NULL when any argument is NULL or the result is not a number. The series
    runs as a few chained projections, which keeps each generated method
    small enough for whole-stage codegen.
    """
    e, n, z = F.col(easting).cast("double"), F.col(northing).cast("double"), F.col(zone)
    stages = _utm_stages(e, n, z)
    # Stages that do not read each other share one projection.
    for group in (stages[0:2], stages[2:4], stages[4:5], stages[5:7]):
        df = df.select("*", *[col.alias(name) for name, col in group])
    lat, lon = F.col("__lat"), F.col("__lon")
    ok = e.isNotNull() & n.isNotNull() & z.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    df = df.withColumn(out, F.when(ok, F.struct(
        round_half_away(lat, LATLON_DIGITS).alias("latitude"),
        round_half_away(lon, LATLON_DIGITS).alias("longitude"))))
    return df.drop(*[name for name, _ in stages])


def grid_snap(deg, step: float = GRID_STEP) -> Column:
    """Nearest grid line (halves away from zero): round(x / step) * step."""
    inv = 1.0 / step
    return F.round(as_col(deg) * _lit(inv)) / _lit(inv)


def haversine_m(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres on a sphere."""
    rad = _lit(math.pi) / _lit(180.0)
    p1, p2 = as_col(lat1) * rad, as_col(lat2) * rad
    dphi = (as_col(lat2) - as_col(lat1)) * rad
    dlam = (as_col(lon2) - as_col(lon1)) * rad
    h = (F.pow(F.sin(dphi / _lit(2.0)), 2)
         + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlam / _lit(2.0)), 2))
    return _lit(2.0 * radius) * F.asin(F.sqrt(h))


def wkt_point(lon, lat) -> Column:
    """Geography point as WKT text 'POINT(lon lat)'; NULL when either is NULL."""
    return F.concat(F.lit("POINT("), as_col(lon).cast("string"), F.lit(" "),
                    as_col(lat).cast("string"), F.lit(")"))
