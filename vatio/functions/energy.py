"""Energy-domain classifications and ERA5 unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col
from .numeric import round_half_away, safe_divide

# ---- Fixed values -----------------------------------------------------------
# Technologies counted as renewable (exact, accent-sensitive match).
RENEWABLE_TECHNOLOGIES = (
    "Solar",
    "Eolica",
    "Mini Hidráulica de Pasada",
    "Hidráulica de Pasada",
    "Geotérmica",
    "Biomasa",
    "Biogás",
)
RENEWABLE = "Renovable"
CONVENTIONAL = "Convencional"
# Distance-to-cell categories: upper bounds in metres (exclusive), then the rest.
PRECISION_CATEGORIES = (
    (1000.0, "Perfecta"),
    (5000.0, "Excelente"),
    (10000.0, "Buena"),
    (15000.0, "Regular"),
)
PRECISION_OTHERWISE = "Mala"
KELVIN_OFFSET = 273.15
SECONDS_PER_HOUR = 3600.0
# -----------------------------------------------------------------------------


def classify_source(tech) -> Column:
    """'Renovable' for the listed technologies, else (NULL included) 'Convencional'."""
    return F.when(as_col(tech).isin(*RENEWABLE_TECHNOLOGIES), F.lit(RENEWABLE)) \
        .otherwise(F.lit(CONVENTIONAL))


def precision_category(distance_m) -> Column:
    """Bucket a distance; NULL falls through to the last label."""
    d = as_col(distance_m)
    expr = None
    lower = None
    for upper, label in PRECISION_CATEGORIES:
        cond = d < F.lit(upper) if lower is None else (d >= F.lit(lower)) & (d < F.lit(upper))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        lower = upper
    return expr.otherwise(F.lit(PRECISION_OTHERWISE))


def kelvin_to_celsius(c, digits: int = 2) -> Column:
    return round_half_away(as_col(c) - F.lit(KELVIN_OFFSET), digits)


def per_hour_energy_to_power(c, digits: int = 2) -> Column:
    """Hourly accumulated J/m^2 -> mean W/m^2."""
    return round_half_away(as_col(c) / F.lit(SECONDS_PER_HOUR), digits)


def fraction_to_pct(c, digits: int = 1) -> Column:
    return round_half_away(as_col(c) * F.lit(100.0), digits)


def direct_fraction(direct, total, digits: int = 4) -> Column:
    """direct / total, NULL when total is 0 or NULL."""
    return round_half_away(safe_divide(direct, F.nullif(as_col(total), F.lit(0.0))), digits)
