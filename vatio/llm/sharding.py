"""Sharding by rendezvous hashing: every record draws one value per shard from
its key, and the smallest weighted value wins. Adding a shard adds one draw per
record, so records move only into the new shard; a shard's share follows its
weight. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Hex digits of an MD5 that make a draw: 13 digits are 52 bits, exact in a double.
DRAW_DIGITS = 13
#: Hex digits of the key's MD5 that cut a shard into slot ranges (16**3 per shard).
RANGE_DIGITS = 3


def key_text(key: Column) -> Column:
    """The stable record key as text; null is the empty key."""
    return F.coalesce(key.cast("string"), F.lit(""))


def _draws(key: Column, weights: Sequence[float]) -> Column:
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("shard weights must be positive")
    draws = []
    for shard, weight in enumerate(weights):
        digest = F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary"))
        number = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("bigint")
        uniform = (number + F.lit(0.5)) / F.lit(float(16 ** DRAW_DIGITS))
        draws.append(F.struct((-F.log(uniform) / F.lit(float(weight))).alias("draw"),
                              F.lit(shard).alias("shard")))
    return F.array(*draws)


def assign_shards(df: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * 16,
                  shard: str = "shard", grown: str | None = None,
                  grown_weight: float = 1.0) -> DataFrame:
    """``df`` with ``shard`` (0 .. len(weights)-1) and, if ``grown`` is named,
    the shard under one more shard of ``grown_weight``.

    A projection: no shuffle, any number of rows. Ties of a draw go to the
    smaller shard. A null key is the empty key; rows with equal keys share a
    shard whatever their other columns hold. Columns of ``df`` with the output
    names are replaced. An empty table stays empty.
    """
    n = len(weights)
    drawn = df.withColumn("__draws", _draws(key_text(F.col(key)), [*weights, grown_weight] if grown
                                            else list(weights)))
    out = drawn.withColumn(shard, F.array_min(F.slice("__draws", 1, n))["shard"])
    if grown:
        out = out.withColumn(grown, F.array_min(F.col("__draws"))["shard"])
    return out.drop("__draws")


def number_slots(rows: DataFrame, shard: str, key_digest: str, columns: Sequence[str],
                 slot: str = "slot") -> DataFrame:
    """One row per input row with ``shard``, ``columns`` and a gapless ``slot``
    from 0 in each shard, in the order of (``key_digest``, ``columns``).

    ``key_digest`` should differ between rows that differ in ``columns``: a digest of an id
    alone would leave all texts of one id in one range. Equal rows collapse to a count
    before the shuffle. A shard is cut into
    16**RANGE_DIGITS ranges of the digest; the ranges' counts (a bounded table:
    shards times ranges) give each its first slot, and a window numbers inside
    a range only. Counts are spread out again at the end.
    """
    order = [key_digest, *columns]
    counted = (rows.groupBy(shard, *order).agg(F.count("*").alias("__copies"))
               .withColumn("__range", F.substring(key_digest, 1, RANGE_DIGITS)))
    per_range = counted.groupBy(shard, "__range").agg(F.sum("__copies").alias("__rows"))
    starts = per_range.select(shard, "__range", (
        F.sum("__rows").over(Window.partitionBy(shard).orderBy("__range")) - F.col("__rows"))
        .alias("__start"))
    inside = Window.partitionBy(shard, "__range").orderBy(*order)
    placed = (counted.withColumn("__end", F.sum("__copies").over(inside))
              .join(F.broadcast(starts), [shard, "__range"]))
    first = F.col("__start") + F.col("__end") - F.col("__copies")
    return placed.select(shard, *columns, F.explode(
        F.sequence(first, F.col("__start") + F.col("__end") - 1)).alias(slot))


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """Write one folder per shard. REBALANCE lets Spark split a large shard
    over several files."""
    df.hint("rebalance", shard).write.partitionBy(shard).mode("overwrite").parquet(path)
