"""Two-level aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_of_member_max(df: DataFrame, group: Sequence[str], member: str, value: str,
                      alias: str) -> DataFrame:
    """sum over members of (max value per member) per group, e.g. installed
    capacity = sum over plants of each plant's max rating in the group."""
    per_member = df.groupBy(*group, member).agg(F.max(value).alias("__m"))
    return per_member.groupBy(*group).agg(F.sum("__m").alias(alias))


def peak_valley(df: DataFrame, group: Sequence[str], slot: str, value: str,
                max_alias: str, min_alias: str) -> DataFrame:
    """Sum ``value`` per (group, slot), then max and min of those sums per group."""
    per_slot = df.groupBy(*group, slot).agg(F.sum(value).alias("__s"))
    return per_slot.groupBy(*group).agg(F.max("__s").alias(max_alias),
                                        F.min("__s").alias(min_alias))
