"""Benchmark decontamination: windows of a document as long as a benchmark item
are fingerprinted by SimHash, fingerprints within a radius of an item's are
found through an index on blocks of their bits, and the weighted similarity of
the word shingles decides. DataFrame functions only.

Shingles of five words of lower-cased letters and digits (an item of fewer
words is one shingle); a shingle's weight is its number of occurrences; the
similarity is the weighted Jaccard: the sum of the smaller weights over the sum
of the larger ones.

Only windows that can reach the threshold are fingerprinted: a similarity of t
between windows of A and B shingles needs t / (1 + t) * (A + B) shared ones, so
a window with fewer positions whose shingle the item has is out. This loses no
window, and leaves the windows around passages of the benchmark.

The radius is a bound on the fingerprints, not on the similarity. Windows of items
with few different shingles, whose fingerprints tell little, are all compared
exactly; of other windows right at the threshold some 0.05 to 0.08 % lie outside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_names, plain_names, row_key, written

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
#: Differing bits allowed. Jaccard 0.8 is an angle of about 0.48 between the weight
#: vectors: 9.7 of 64 bits on average, with a standard deviation of 2.9.
RADIUS = 20
BITS = 64
#: Items of up to so many different shingles are compared without the index: their
#: fingerprints are made of few hashes, and say little of the similarity.
FEW_SHINGLES = 16
#: Rows of a side that may be broadcast (32 bytes each); above, Spark shuffles.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null gives none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(ws: str, width: int) -> Column:
    """Hashes of the shingles of ``width`` words at each position."""
    at = F.when(F.size(ws) >= width, F.sequence(F.lit(1), F.size(ws) - width + 1)) \
        .otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.element_at(F.col(ws), i + j) for j in range(width)]))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a written table of a checked number of rows."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _fingerprint(hashes: Column) -> Column:
    """Aggregate: a bit is set if more than half of the hashes have it."""
    bits = [F.when(2 * F.sum(F.shiftrightunsigned(hashes, b).bitwiseAND(1)) > F.count("*"),
                   F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)) for b in range(BITS)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return total


def _blocks(fp: str, radius: int) -> Column:
    """(block, value) for radius + 1 blocks of bits: two fingerprints within the
    radius agree on one block at least."""
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    return F.explode(F.array(*[F.struct(F.lit(i).alias("no"), F.shiftrightunsigned(fp, a).bitwiseAND(
        (1 << (b - a)) - 1).alias("value")) for i, (a, b) in enumerate(zip(edges, edges[1:]))]))


def _needed(a: Column, b: Column, similarity: float) -> Column:
    """Least weight that weighted sets of weights a and b share at a similarity."""
    return F.ceil(F.lit(similarity / (1 + similarity)) * (a + b) - F.lit(1e-9))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = MIN_SIMILARITY,
            radius: int = RADIUS, text: str = "text") -> DataFrame:
    """(doc_key1, doc_key2, item_id, similarity, window_start, window_words): per
    document and item the most similar window, where it reaches ``similarity``.
    The keys are :func:`row_key` of the documents' rows with seeds 0 and 1.

    ``window_start`` counts words from 0; the earliest of equally similar
    windows. A document shorter than an item is one window. Null and wordless
    texts and items match nothing. Rows equal in every column give one row.
    Each text of an item_id is compared by itself, and the best one counts; a
    null item_id is an id like any other.
    """
    spark = docs.sparkSession
    items = written(benchmark.select("item_id", words(F.col("text")).alias("ws")).distinct()
                    .withColumn("item", F.xxhash64(F.col("item_id").isNull(), "item_id", "ws"))
                    .withColumn("n", F.size("ws")).filter("n > 0")
                    .withColumn("width", F.least("n", F.lit(SHINGLE_WORDS))), "items")
    widths = [r[0] for r in items.select("width").distinct().collect()]  # five values at most
    spec = ("doc_key1 long, doc_key2 long, item_id long, similarity double, "
            "window_start int, window_words int")
    if not widths:
        return spark.createDataFrame([], spec)
    by_width = [items.filter(F.col("width") == k).select(
        "item", "n", "width", F.posexplode(_shingles("ws", k)).alias("at", "h")) for k in widths]
    shingles = by_width[0]
    for more in by_width[1:]:
        shingles = shingles.unionByName(more)
    counts = written(shingles.groupBy("item", "n", "width", "h").agg(F.count("*").alias("w")), "item-shingles")
    n_rows = counts.count()
    index = _small(counts.select("item", "n", "width", "h"), n_rows)

    keyed = docs.select(row_key(docs).alias("doc_key1"), row_key(docs, 1).alias("doc_key2"),
                        words(F.col(text)).alias("ws")).withColumn("m", F.size("ws"))
    placed = [keyed.select("doc_key1", "doc_key2", "m", F.posexplode(_shingles("ws", k)).alias("p", "h"))
              .withColumn("width", F.lit(k)) for k in widths]
    rows = placed[0]
    for more in placed[1:]:
        rows = rows.unionByName(more)
    hits = rows.join(index, ["h", "width"]).select("doc_key1", "doc_key2", "m", "item", "n", "width", "p").distinct()
    # Windows that hold a shared position, by item; those with enough of them stay.
    size = F.least("n", "m") - F.col("width") + 1
    starts = F.sequence(F.greatest(F.lit(0), F.col("p") - size + 1),
                        F.least(F.col("p"), F.greatest(F.lit(0), F.col("m") - F.col("n"))))
    near = (hits.filter(F.col("p") - size + 1 <= F.greatest(F.lit(0), F.col("m") - F.col("n")))
            .withColumn("s", F.explode(starts))
            .groupBy("doc_key1", "doc_key2", "m", "item", "n", "width", "s").agg(F.count("*").alias("shared"))
            .filter(F.col("shared") >= _needed(size, F.col("n") - F.col("width") + 1, similarity)))
    near = written(near, "window-items")
    windows = written(near.select("doc_key1", "doc_key2", "n", "width", "s").distinct(), "windows")

    touched = written(windows.select("doc_key1", "doc_key2").distinct(), "window-documents")
    found = keyed.join(_small(touched, touched.count()), ["doc_key1", "doc_key2"], "left_semi")
    arrays = [found.select("doc_key1", "doc_key2", "m", F.lit(k).alias("width"), _shingles("ws", k).alias("hs"))
              for k in widths]
    hashed = arrays[0]
    for more in arrays[1:]:
        hashed = hashed.unionByName(more)
    hashed = written(hashed.distinct(), "window-shingles")
    inside = windows.join(hashed, ["doc_key1", "doc_key2", "width"]).select(
        "doc_key1", "doc_key2", "n", "width", "s", F.explode(F.slice(
            "hs", F.col("s") + 1, F.least("n", "m") - F.col("width") + 1)).alias("h"))
    key = ["doc_key1", "doc_key2", "n", "width", "s"]
    weighed = written(inside.groupBy(*key, "h").agg(F.count("*").alias("w")), "window-weights")

    prints = weighed.withColumn("h", F.explode(F.array_repeat("h", F.col("w").cast("int")))) \
        .groupBy(*key).agg(_fingerprint(F.col("h")).alias("fp"), F.count("*").alias("size"))
    item_prints = counts.withColumn("h", F.explode(F.array_repeat("h", F.col("w").cast("int")))) \
        .groupBy("item", "n", "width").agg(_fingerprint(F.col("h")).alias("item_fp"), F.count("*").alias("item_size"))
    blocks = item_prints.withColumn("block", _blocks("item_fp", radius)).select(
        "item", "n", "width", "item_fp", "item_size", "block.no", "block.value")
    blocks = _small(written(blocks, "item-blocks"), n_rows * (radius + 1))
    candidates = (prints.withColumn("block", _blocks("fp", radius))
                  .select(*key, "fp", "size", "block.no", "block.value")
                  .join(blocks, ["n", "width", "no", "value"])
                  .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
                  .select(*key, "item", "size", "item_size"))
    few = counts.groupBy("item").agg(F.count("*").alias("different"), F.sum("w").alias("item_size")) \
        .filter(F.col("different") <= FEW_SHINGLES).select("item", "item_size")
    direct = near.join(_small(few, n_rows), "item").select(*key, "item", size.cast("bigint").alias("size"), "item_size")
    candidates = candidates.unionByName(direct).distinct()
    shared = (candidates.join(weighed, key)
              .join(_small(counts.select("item", "h", F.col("w").alias("item_w")), n_rows), ["item", "h"])
              .groupBy(*key, "item", "size", "item_size").agg(F.sum(F.least("w", "item_w")).alias("both")))
    scored = shared.withColumn("similarity", F.col("both") / (F.col("size") + F.col("item_size") - F.col("both"))) \
        .filter(F.col("similarity") >= similarity)
    ids = items.select("item", "item_id")
    best = scored.join(_small(ids, n_rows), "item").groupBy("doc_key1", "doc_key2", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("s")).alias("s"), (F.col("size") + F.col("width") - 1).alias("words"))).alias("b"))
    return best.select("doc_key1", "doc_key2", "item_id", "b.similarity", (-F.col("b.s")).alias("window_start"),
                       F.col("b.words").cast("int").alias("window_words"))


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = MIN_SIMILARITY,
          radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`matches` with the ``doc_id`` of the documents in place of the keys."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = matches(own, benchmark, similarity, radius)
    keys = found.select("doc_key1", "doc_key2").distinct()
    ids = own.select(row_key(own).alias("doc_key1"), row_key(own, 1).alias("doc_key2"), "doc_id") \
        .join(keys, ["doc_key1", "doc_key2"], "left_semi").distinct()
    return ids.join(found, ["doc_key1", "doc_key2"]).drop("doc_key1", "doc_key2")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = MIN_SIMILARITY,
                 radius: int = RADIUS, text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a window similar to an item."""
    found = written(matches(docs, benchmark, similarity, radius, text)
                    .select("doc_key1", "doc_key2").distinct(), "leaks")
    own = plain_names(docs)
    keyed = own.withColumn("doc_key1", row_key(own)).withColumn("doc_key2", row_key(own, 1))
    return own_names(keyed.join(_small(found, found.count()), ["doc_key1", "doc_key2"], "left_anti"), docs)
