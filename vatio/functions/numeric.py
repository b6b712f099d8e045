"""Safe division and engine-independent rounding (H7, H8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def safe_divide(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL."""
    return F.try_divide(as_col(a), as_col(b))


def round_half_away(c, digits: int = 0) -> Column:
    """Round to ``digits`` places, halves away from zero, on the scaled value.

    ``round(x * 10^d) / 10^d`` gives the same double in Spark and in DuckDB,
    whereas a native ``round(x, d)`` rounds the decimal text in Spark and the
    scaled binary value elsewhere.
    """
    x = as_col(c).cast("double")
    if digits == 0:
        return F.round(x)
    scale = float(10 ** digits)
    return F.round(x * F.lit(scale)) / F.lit(scale)
