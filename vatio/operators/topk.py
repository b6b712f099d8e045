"""Top-1 per group (E3, F1) as an aggregate.

``min(struct(value IS NULL, -value, tie...))`` picks the largest value, NULL
values last, ties broken by the ascending tie columns (NULL first), with
partial aggregation before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top1_per_group(df: DataFrame, group: Sequence[str], value: str,
                   tie_asc: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per ``group``: the columns ``keep`` of the row with max ``value``."""
    v = F.col(value)
    fields = [v.isNull().alias("n"), (-v).alias("v")]
    fields += [F.col(c).alias(f"t{i}") for i, c in enumerate(tie_asc)]
    fields += [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    best = df.groupBy(*group).agg(F.min(F.struct(*fields)).alias("__top"))
    return best.select(*group, *[F.col(f"__top.k{i}").alias(c) for i, c in enumerate(keep)])
