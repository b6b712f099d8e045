"""Mixing sources to target weights by weighted fair queueing: the documents of
a source are shuffled, each gets a virtual finish time (the source's words up
to it divided by the source's target), and all entries, range-sorted by finish
time, are taken up to the total budget."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_names, plain, plain_names, running_sum, words_in, written

#: Relative weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a multiple of the words of the corpus.
TOTAL = 1.5
#: Times a source may be read at most.
EPOCHS = 2


def shuffle_key(df: DataFrame) -> Column:
    """60 bits of an MD5 over all columns of a row: the shuffled order of the
    documents. Null and column ends have characters of their own."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        plain = f.dataType.simpleString().partition("<")[0] not in ("array", "map", "struct", "variant")
        parts += [F.coalesce(c.cast("string") if plain else F.to_json(F.struct(c.alias("v"))),
                             F.lit("\x01")), F.lit("\x02")]
    return F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 15), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL,
                   epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, rank, target) from ``sizes`` (source, source_size).

    Sources rank by code point, null last; the weights repeat along the ranks.
    ``total`` times all words are shared by weight; a share above ``epochs``
    times its source's size stops there, and what is left is shared again by
    weight until no share is above its stop. Only two sums reach the driver per
    round; every round stops at least one more source.
    """
    ranked = running_sum(sizes.withColumn("__one", F.lit(1).cast("bigint"))
                         .withColumn("__null", F.col("source").isNull().cast("int")),
                         ["__null", "source"], "__one", "rank")
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = written(ranked.select(
        "source", "source_size", (F.col("rank") - 1).alias("rank"),
        F.element_at(table, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).alias("weight")),
        "sources")
    stop = F.col("source_size") * F.lit(float(epochs))
    words = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, rate, stopped = words * float(total), None, -1
    # Shares are rate * weight; a share once above its stop stays there as the rate only rises.
    above = F.lit(False)
    while True:
        n, held, free = ranked.agg(F.count_if(above), F.sum(F.when(above, stop).otherwise(0.0)),
                                   F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        if not free or n == stopped:
            break
        rate, stopped = (budget - held) / free, n
        above = F.col("weight") * F.lit(rate) > stop
    share = F.least(F.col("weight") * F.lit(rate or 0.0), stop)
    return ranked.select("source", "source_size", "rank", share.alias("target"))


def queue_cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, cut, cut_copies, cut_taken): how far the
    mix reads each source. Documents whose order key is under ``cut`` are read
    ``epochs`` + 1 times and the others ``epochs`` times; of the ``cut_copies``
    equal rows at the key ``cut``, ``cut_taken`` are read once more.

    ``rows``: source, key (the shuffle order: a hash of the row) and size.
    """
    # Equal rows collapse before the sort, so that a large group of copies is no task's burden.
    groups = (rows.filter("size > 0").groupBy("source", "key", "size")
              .agg(F.count("*").alias("copies")).withColumn("words", F.col("size") * F.col("copies")))
    keyed = F.col("s.source").eqNullSafe(F.col("t.source"))
    placed = groups.alias("s").join(targets.alias("t"), keyed).select(
        "t.rank", "s.key", "s.size", "s.copies", "s.words", "t.source_size", "t.target")
    total = running_sum(placed, ["rank", "key", "size"], "words", "upto")
    starts = total.groupBy("rank").agg(F.min(F.col("upto") - F.col("words")).alias("start"))
    queue = (total.join(starts, "rank")
             .withColumn("begin", F.col("upto") - F.col("words") - F.col("start"))
             .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
             .withColumn("epoch", F.explode(F.array(*[F.lit(i) for i in range(EPOCHS)])))
             .withColumn("pos", F.col("epoch") * F.col("source_size") + F.col("begin")
                         + F.col("copy") * F.col("size"))
             .select("rank", "pos", "epoch", "key", "size", "copies", "copy",
                     (F.col("pos") / F.col("target")).alias("finish")))
    sorted_sum = running_sum(queue, ["finish", "rank", "pos"], "size", "taken")
    # The targets add up to half words at most but for rounding; whole documents are counted.
    budget = math.floor((targets.agg(F.sum("target")).first()[0] or 0.0) + 0.25)
    last = (sorted_sum.filter(F.col("taken") <= F.lit(budget)).groupBy("rank")
            .agg(F.max(F.struct("pos", "epoch", "key", "copies", "copy")).alias("last")))
    # The entry of the first epoch that was not reached leaves its source with no cut.
    return targets.join(last, "rank", "left").select(
        "source", "source_size", "target", F.coalesce("last.epoch", F.lit(0)).alias("epochs"),
        F.col("last.key").alias("cut"), F.col("last.copies").alias("cut_copies"),
        F.col("last.copy").alias("cut_taken"))


def mix_counts(docs: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL,
               text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``size`` (words of the text), ``source_size``, ``target``
    (the source's words and its share of the mix) and ``times`` (how often the
    mix reads the document: 0, 1 or 2).

    Shuffled by a hash of the whole row, so reruns agree and rows that are
    equal in every column are interchangeable. Null text counts as empty; a
    document without words is never read; a null source is a source of its own,
    ranked last. Only hashes and sizes are shuffled; texts stay where they are,
    but for equal rows that straddle a cut. Columns of ``docs`` with the names
    of the outputs are replaced.
    """
    docs = docs.drop(*[c for c in ("size", "source_size", "target", "times") if c != source])
    seeded = docs.withColumn("__key", shuffle_key(docs)).withColumn("__size", words_in(F.col(text)))
    rows = written(seeded.select(F.col(source).cast("string").alias("source"),
                                 F.col("__key").alias("key"), F.col("__size").alias("size")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights, total), "targets")
    cuts = written(queue_cuts(rows, targets), "cuts")
    own = [F.col(f"d.`{c}`") for c in docs.columns]
    joined = seeded.alias("d").join(
        cuts.withColumnRenamed("source", "__source").alias("c"),
        F.col(f"d.`{source}`").cast("string").eqNullSafe(F.col("c.__source")))
    at, under = F.col("__key") == F.col("cut"), F.col("__key") < F.col("cut")
    whole = under | (at & (F.col("cut_taken") == F.col("cut_copies")))
    times = F.when(F.col("__size") == 0, 0).otherwise(
        F.col("epochs") + F.coalesce(whole, F.lit(False)).cast("int"))
    figures = [F.col("__size").alias("size"), F.col("source_size"), F.col("target")]
    plain = joined.select(*own, *figures, times.cast("int").alias("times"),
                          F.coalesce(at & ~whole & (F.col("__size") > 0), F.lit(False)).alias("__split"))
    if cuts.filter("cut_taken < cut_copies").isEmpty():
        return plain.drop("__split")
    # Equal rows at a cut: the first cut_taken of them are read once more.
    split = joined.filter(at & ~whole & (F.col("__size") > 0)).groupBy("__key", "epochs", "cut_taken").agg(
        F.count("*").alias("__n"), F.first(F.struct(*own, *figures)).alias("__row"))
    parts = split.select("__row.*", F.explode(F.array(
        F.struct((F.col("epochs") + 1).alias("t"), F.col("cut_taken").cast("bigint").alias("n")),
        F.struct(F.col("epochs").alias("t"), (F.col("__n") - F.col("cut_taken")).alias("n")))).alias("__p"))
    spread = parts.withColumn("__i", F.explode(F.expr(
        "if(__p.n > 0, sequence(1L, __p.n), cast(array() as array<bigint>))")))
    again = spread.withColumn("times", F.col("__p.t").cast("int")).drop("__p", "__i")
    return plain.filter(~F.col("__split")).drop("__split").unionByName(again.select(
        *[F.col(f"`{c}`") for c in plain.columns if c != "__split"]))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL,
        text: str = "text", source: str = "source") -> DataFrame:
    """The mixed corpus: the columns of ``docs`` as they are, whatever their names, each
    document as often as :func:`mix_counts` reads it."""
    counted = mix_counts(plain_names(docs), weights, total, plain(docs, text), plain(docs, source)).filter("times > 0")
    return own_names(counted.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("times")))), docs)
