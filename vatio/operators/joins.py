"""Joins to dimension tables (C1, C2, C5) with a checked broadcast.

The dimension side is counted first (one partial count per task, no rows are
moved) and broadcast only when its rows times the width of a row stay within
BROADCAST_MAX_BYTES; above, the join is left to the planner (sort-merge, with
AQE skew splitting). Both ways give the same rows.

Spark's own size estimate is not usable for this: without cost-based
statistics an inner join is estimated as the product of its sides, so the
registry (supplier x nation x region, then an aggregate) is "estimated" at
tens of GB while holding a few thousand rows, and the planner would
re-shuffle the hourly fact by plant instead of broadcasting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of a dimension that may be broadcast, by counted rows and the width of its types.
BROADCAST_MAX_BYTES = 256 << 20
# Width taken for values of variable length (names, WKT points).
TEXT_BYTES = 64


def row_bytes(df: DataFrame) -> int:
    """Width of a row: 8 bytes a value and its null bit, more for text and nested values."""
    simple = ("bigint", "int", "double", "date", "timestamp_ntz", "timestamp", "boolean", "float", "smallint")
    return 16 + sum(8 if t in simple else 8 + TEXT_BYTES for _, t in df.dtypes)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when all rows of ``df`` together stay within the bound."""
    limit = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    return df.count() * row_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def join_dimension(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str,
                   how: str = "inner", small: bool | None = None,
                   max_bytes: int | None = None) -> DataFrame:
    """Join a dimension; ``small`` passes a bound already proven for it (for
    instance a subset or projection of a table that was counted), otherwise
    it is counted here."""
    if small is None:
        small = fits_broadcast(dim, max_bytes)
    return fact.join(F.broadcast(dim) if small else dim, on, how)
