"""SimHash near-duplicates over BK-trees.

A document's fingerprint has a bit for each of 64 positions, set when more than
half of its word shingles' hashes have it. Fingerprints within ``max_bits``
differing bits are linked and linked documents form groups.

Trees over all fingerprints would have to be sent everywhere and grow with the
corpus, so the fingerprints are cut into shards that no link can cross: with
``max_bits`` + 2 blocks of bits, two linked fingerprints agree on two blocks at
least, and each pair of blocks keys a shard. A shard's BK-tree is built in the
task that holds its members, which query it. A shard of more than TREE_LIMIT
fingerprints (close variants of one text) is dealt anew: its members go to all
points within half the radius, where any two linked ones meet, and a point has
no more members than such points around it (65 for two bits)."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, own_names, plain, plain_names, row_key, ship, written

BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
#: Fingerprints in one BK-tree at most; larger shards are dealt anew.
TREE_LIMIT = 512


def fingerprint_of(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a text as an unsigned integer; no words: 0."""
    # bytes.lower folds A-Z only; bytes.split cuts at space, tab, LF, VT, FF, CR only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], HASH_SEED)
                       for a, b in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())])
    n, counts = len(hashes) // 8, np.zeros(BITS, np.int64)
    rows = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for i in range(0, n, 1 << 15):  # a long text's bits in bounded memory
        counts += np.unpackbits(rows[i:i + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def fingerprint(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long."""
    @F.pandas_udf("long")
    def make(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint_of(t, width)) for t in texts], dtype="int64")
    return make(text)


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


class BKTree:
    """Children of a node are keyed by their Hamming distance to it."""

    def __init__(self, root: int):
        self.values, self.children = [root], [{}]

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of the stored values within the radius: only edges whose
        distance differs from the node's by the radius at most can hold one."""
        found, todo = [], [0]
        while todo:
            i = todo.pop()
            d = (self.values[i] ^ value).bit_count()
            if d <= radius:
                found.append(i)
            kids = self.children[i]
            todo += [kids[k] for k in range(d - radius, d + radius + 1) if k in kids]
        return found

    def add(self, value: int) -> int:
        i = 0
        while True:
            d = (self.values[i] ^ value).bit_count()
            if d not in self.children[i]:
                self.children[i][d] = len(self.values)
                self.values.append(value)
                self.children.append({})
                return len(self.values) - 1
            i = self.children[i][d]


def tree_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what is within the radius among distinct values: of the
    links found, those that connect two parts not yet connected."""
    if len(values) == 2:
        a, b = values
        return [(a, b)] if (a ^ b).bit_count() <= radius else []
    tree, part, links = BKTree(values[0]), [0], []

    def find(i: int) -> int:
        while part[i] != i:
            part[i] = part[part[i]]
            i = part[i]
        return i

    for v in values[1:]:
        near = tree.within(v, radius)
        at = tree.add(v)
        part.append(at)
        for i in near:
            if find(i) != find(at):
                links.append((tree.values[i], v))
                part[find(i)] = find(at)
    return links


def _shard_links(shards: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) inside each shard of (shard, key, fp); every shard is within
    a bounded size, so a task holds one tree at a time."""
    ship(shards)
    mask = (1 << BITS) - 1

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, members = None, []

        def close() -> list[tuple[int, int]]:
            if len(members) < 2:
                return []
            return [(_signed(a), _signed(b)) for a, b in tree_links([m & mask for m in members], radius)]

        for b in batches:
            out: list[tuple[int, int]] = []
            for shard, key, fp in zip(b["shard"].tolist(), b["key"].tolist(), b["fp"].tolist()):
                if (shard, key) != at:
                    out += close()
                    at, members = (shard, key), []
                members.append(fp)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(close(), columns=["a", "b"], dtype="int64")

    return (shards.select("shard", "key", "fp").repartition("shard", "key")
            .sortWithinPartitions("shard", "key", "fp").mapInPandas(link, "a long, b long"))


def _crowded(shards: DataFrame) -> DataFrame:
    """(shard, key, members) of the shards with two members or more."""
    return shards.groupBy("shard", "key").agg(F.count("*").alias("members")).filter("members > 1")


def links(fps: DataFrame, max_bits: int = MAX_BITS, tree_limit: int = TREE_LIMIT) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` (signed long) that
    connect all within ``max_bits`` differing bits: enough of them that two
    fingerprints are connected exactly if a chain of such steps connects them."""
    blocks = max_bits + 2
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    pairs = [_signed(masks[i] | masks[j]) for i, j in itertools.combinations(range(blocks), 2)]
    shards = fps.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m)) for m in pairs])).alias("shard", "key"))
    shared = written(shards.join(_crowded(shards), ["shard", "key"]), "shards")
    found = _shard_links(shared.filter(F.col("members") <= tree_limit), max_bits)
    large = shared.filter(F.col("members") > tree_limit).select("fp").distinct()
    flips = [_signed(sum(1 << b for b in bits)) for n in range((max_bits + 1) // 2 + 1)
             for bits in itertools.combinations(range(BITS), n)]
    points = large.select("fp", F.lit(-1).alias("shard"), F.explode(F.array(
        *[F.col("fp").bitwiseXOR(F.lit(x)) for x in flips])).alias("key"))
    met = points.join(_crowded(points), ["shard", "key"])
    return found.unionByName(_shard_links(met, max_bits))


def components(rows: DataFrame, max_bits: int = MAX_BITS, tree_limit: int = TREE_LIMIT) -> DataFrame:
    """(fp, component_id) from ``rows`` (doc_id, fp): the smallest doc_id whose
    fingerprint a chain of links reaches."""
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("id")), "fingerprints")
    roots = connected_components(links(nodes.select("fp"), max_bits, tree_limit))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return written(rooted.join(least, "root").select("fp", "component_id"), "components")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, width: int = SHINGLE_WORDS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    Null and wordless texts have fingerprint zero and are linked like any
    other. Rows with a null doc_id take part; a component of such rows only has
    a null id. Other columns of ``docs`` are ignored. An empty table gives none.
    """
    ship(docs)
    rows = written(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), width).alias("fp")),
                   "document-fingerprints")
    return rows.join(components(rows, max_bits), "fp").select(
        "doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, width: int = SHINGLE_WORDS,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` less all but one document of each group: the smallest doc_id
    stays (null last), of its rows the one with the smallest row hash; rows
    equal in every column count as one. The texts are shuffled once, after
    equal rows have been put together in the map tasks."""
    ship(docs)
    own = plain_names(docs)
    keyed = own.withColumn("__k1", row_key(own)).withColumn("__k2", row_key(own, 1))
    rows = written(keyed.select(F.col(plain(docs, doc_id)).alias("doc_id"), "__k1", "__k2",
                                fingerprint(F.col(plain(docs, text)), width).alias("fp")), "document-fingerprints")
    best = (rows.join(components(rows, max_bits), "fp")
            # A component without any id is named by its fingerprint's chain: its null ids stay apart by fp.
            .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("__fp"))
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__k1", "__k2")).alias("best"))
            .select("best.__k1", "best.__k2"))
    one = keyed.groupBy("__k1", "__k2").agg(F.first(F.struct(*own.columns)).alias("__row"))
    return own_names(one.join(written(best, "kept"), ["__k1", "__k2"], "left_semi").select("__row.*"), docs)
