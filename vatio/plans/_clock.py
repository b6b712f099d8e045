from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.time import utc_now_ntz


def clock(value: datetime | str | Column | None) -> Column:
    """An injectable run clock: explicit value, or the current UTC instant."""
    if value is None:
        return utc_now_ntz()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")
