"""Forward fill of NULLs along time per key (E4, LAST_VALUE IGNORE NULLS).

A plain ``last(ignorenulls) over (partition by key order by ts)`` sends the
whole history of a key to one task. Here the work is split by (key, day):
1. per (key, day) the last non-NULL value of the day (an aggregate);
2. per key, the value carried into each day = last non-NULL of the earlier
   days (a window over day summaries only: one row per key-day);
3. inside each (key, day) the running last non-NULL, falling back to the
   carried value.
So no task ever holds more than one key-day of raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def forward_fill(df: DataFrame, key: str, ts: str, cols: Sequence[str],
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    day = "__ff_day"
    base = df.withColumn(day, F.to_date(F.col(ts)))
    order = [F.col(ts)] + [F.col(c) for c in tiebreak]
    summaries = base.groupBy(key, day).agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("v")))).alias(f"__last_{c}")
        for c in cols])
    prev_days = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    carried = summaries.select(key, day, *[
        F.last(F.col(f"__last_{c}.v"), ignorenulls=True).over(prev_days).alias(f"__carry_{c}")
        for c in cols])
    within = Window.partitionBy(key, day).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = base.join(carried, [key, day], "left")
    filled = joined.select(*[
        F.coalesce(F.last(F.col(c), ignorenulls=True).over(within), F.col(f"__carry_{c}")).alias(c)
        if c in cols else F.col(c) for c in df.columns])
    return filled
