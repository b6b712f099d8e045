"""Local time -> UTC, calendar parts and cyclic encodings.

Local datetimes and UTC instants are both ``timestamp_ntz``; conversions use
``convert_timezone``, which does not read the session zone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed value: the zone of the local operating hours.
LOCAL_TZ = "America/Santiago"


def local_midnight_utc(ts_local, tz: str = LOCAL_TZ) -> Column:
    """UTC instant of local midnight of the day of ``ts_local``.

    A midnight skipped by a clock change resolves to the first valid instant
    (2024-09-08 -> 04:00Z).
    """
    midnight = F.to_date(as_col(ts_local)).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), midnight)


def local_hour_to_utc(ts_local, hour_1_24, tz: str = LOCAL_TZ) -> Column:
    """Local midnight in UTC plus (hour - 1) elapsed hours; NULL hour -> NULL.

    Elapsed hours, not wall-clock hours: on a 23-hour day hour 24 lands on the
    next day's hour 1, on a 25-hour day one UTC hour stays empty.
    """
    h = as_col(hour_1_24).try_cast("bigint") - F.lit(1)
    return F.timestamp_add("HOUR", h, local_midnight_utc(ts_local, tz))


# Days covered by the local-midnight calendar (outside it the
# conversion is computed per row).
CALENDAR_START, CALENDAR_DAYS = "1990-01-01", 25567   # 1990-01-01 .. 2059-12-31


def local_midnight_calendar(spark, tz: str = LOCAL_TZ):
    """One row per calendar day: (day, UTC instant of local midnight).

    Fixed size (independent of the data), so it is always safe to broadcast.
    """
    days = spark.range(CALENDAR_DAYS).select(
        F.date_add(F.lit(CALENDAR_START).cast("date"), F.col("id").cast("int")).alias("__cal_day"))
    return days.select("__cal_day", local_midnight_utc(F.col("__cal_day"), tz).alias("__cal_midnight"))


def with_local_hour_utc(df, ts_local: str, hour_1_24: str, out: str, tz: str = LOCAL_TZ):
    """Add ``out`` = :func:`local_hour_to_utc` through a broadcast calendar
    lookup instead of per-row time-zone arithmetic (a hash probe per row)."""
    cal = F.broadcast(local_midnight_calendar(df.sparkSession, tz))
    joined = df.join(cal, F.to_date(F.col(ts_local)) == F.col("__cal_day"), "left")
    midnight = F.coalesce(F.col("__cal_midnight"), local_midnight_utc(ts_local, tz))
    h = F.col(hour_1_24).try_cast("bigint") - F.lit(1)
    return joined.withColumn(out, F.timestamp_add("HOUR", h, midnight)).drop("__cal_day", "__cal_midnight")


def utc_now_ntz() -> Column:
    """Current instant as UTC wall-clock ``timestamp_ntz``."""
    return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))


_PARTS = {
    "hour": F.hour, "month": F.month, "year": F.year, "dayofweek": F.dayofweek,
    "day": F.dayofmonth,
}


def dt_part(part: str, ts) -> Column:
    """Calendar part as bigint; ``dayofweek`` is 1 = Sunday .. 7 = Saturday."""
    return _PARTS[part](as_col(ts)).cast("bigint")


def cyclic(value, period: float, fn: str = "cos", digits: int = 6) -> Column:
    """cos/sin(2*pi*value/period) rounded to ``digits`` places."""
    from .numeric import round_half_away
    angle = F.lit(2.0 * math.pi) * as_col(value).cast("double") / F.lit(float(period))
    return round_half_away(F.cos(angle) if fn == "cos" else F.sin(angle), digits)
