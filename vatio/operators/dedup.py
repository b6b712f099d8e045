"""Latest-wins deduplication.

Expressed as ``groupBy(keys).agg(max(struct(order..., payload...)))`` rather
than ``row_number() over (partition by keys order by ...) = 1``: the max of a
struct is a declarative aggregate, so Spark combines map-side before the
shuffle and a hot key costs one row per map task instead of a whole sorted
partition in one reducer. Struct ordering compares fields left to right with
NULL lowest, which is exactly ``ORDER BY o1 DESC NULLS LAST, o2 DESC NULLS LAST``.
NULL keys form one group, as in a window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                   payload: Sequence[str] | None = None) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order_desc`` tuple.

    ``payload`` defaults to every other column; remaining ties are broken by
    the payload values themselves, so the result is deterministic.
    """
    keys, order_desc = list(keys), list(order_desc)
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c not in order_desc]
    fields = order_desc + [c for c in payload if c not in order_desc]
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    best = df.groupBy(*keys).agg(F.max(packed).alias("__best"))
    out = [F.col(k) for k in keys] + [F.col(f"__best.f{i}").alias(c) for i, c in enumerate(fields)]
    return best.select(*out)
