"""Ranked lexical search over max-sketches (operator 11).

* Index, independent of any query: each document's terms are hashed to
  ``WIDTH`` coordinates and every coordinate keeps the largest frequency that
  falls on it (one byte, rounded up). A term's impact grows with its frequency,
  so the coordinate's impact is at least that of every term on it: the sketch is
  an upper bound of the document, stored as the coordinates that are not empty.
  The same pass counts terms (lengths, document frequencies); each task hands on
  partial counts, and its dictionary never grows beyond ``HELD`` terms.
* Look-up: all items of a block of queries at once. An item's weights meet a
  sketch on the coordinates of its terms; the sum bounds the document's score.
* Rescoring: documents are scored exactly from their whole texts in descending
  order of the bound. The first round takes the best bounds of each item; its
  tenth best score is the threshold. All documents whose bound reaches it are
  then taken in rounds of growing size, and each round raises the threshold;
  the search ends when no bound is left above it.

Equal texts are scored once and stand for their smallest ids, at most as many as
the result has ranks. Scores are whole numbers and agree on every run.

Odd input: a null text has no terms and is never found; a null id comes after
all others among equal scores; repeated rows are documents of their own. An item
without terms finds nothing; items are told apart by id and text, and equal
items count once. Empty tables give an empty result. Columns other than the ids
and texts are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written

#: Results of an item.
TOP = 10
#: Coordinates of a sketch; two bytes name one.
WIDTH = 1 << 16
#: Best bounds of each item that are rescored first, and the growth of the later rounds.
FIRST_ROUND, GROWTH = 16, 4
#: Distinct terms that a task counts before it hands them on.
HELD = 200_000
#: Occurrences of terms in a block of queries (about 64 bytes each in a task).
BLOCK_TERMS = 200_000
#: Products that a look-up holds at once, and cells of its table of documents by items.
PORTION, CELLS = 2_000_000, 2_000_000
#: Candidate rows that are broadcast to the documents (id, hash and items: under 64 bytes each).
BROADCAST_ROWS = 200_000

#: Terms are runs of ASCII letters and digits and of everything beyond ASCII; only A-Z are lower-cased.
TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                 for b in range(256))
#: A byte's frequency: exact up to 127, beyond it rounded up in steps of a quarter octave.
FREQUENCY = np.array([*range(128), *(int(np.ceil(128 * 2 ** (i / 4))) for i in range(1, 129))], dtype=np.int64)


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(TO_TERMS).split() if text else []


def impact(tf, m):
    """The part of a term's score that depends on the document, whole-number division."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


INDEX = "doc_id bigint, hash bigint, n bigint, coords binary, freqs binary, term binary, df bigint"
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def _index(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A row for each document (id, hash, n, coordinates, frequencies), and rows of a
    term and the number of the task's documents that hold it."""
    held: Counter = Counter()

    def rows(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(size, t)
                                           for c, t in zip(_NAMES, _TYPES)], names=_NAMES)

    def counted() -> pa.RecordBatch:
        b = rows(len(held), term=pa.array(held.keys(), pa.binary()), df=pa.array(held.values(), pa.int64()))
        held.clear()
        return b

    for batch in batches:
        n, coords, freqs = [], [], []
        for text in batch.column(2):
            found = terms(text.as_py())
            tf = Counter(found)
            n.append(len(found))
            at = np.fromiter((zlib.crc32(t) % width for t in tf), dtype=np.int64, count=len(tf))
            most = np.fromiter(tf.values(), dtype=np.int64, count=len(tf))
            order = np.argsort(at, kind="stable")
            at, most = at[order], most[order]
            first = np.flatnonzero(np.diff(at, prepend=-1))
            coords.append(at[first].astype("<u2").tobytes())
            most = np.maximum.reduceat(most, first) if len(first) else most
            freqs.append(np.searchsorted(FREQUENCY, most).astype("u1").tobytes())
            held.update(tf.keys())
            if len(held) >= HELD:
                yield counted()
        yield rows(len(n), doc_id=batch.column(0), hash=batch.column(1), n=pa.array(n, pa.int64()),
                   coords=pa.array(coords, pa.binary()), freqs=pa.array(freqs, pa.binary()))
    if held:
        yield counted()


def _given(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, hash, t): the hash tells texts apart together with the id of a row that holds it."""
    t = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(t).alias("hash"),
                       F.coalesce(t, F.lit("")).cast("binary").alias("t"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(sketches, term counts), both written: (doc_id, hash, n, coords, freqs) for each
    document with a term, and (term, df) as partial counts of the tasks."""
    ship(docs)
    both = written(_given(docs, id_col, text_col).mapInArrow(partial(_index, width=width), INDEX), "search-index")
    return (both.filter("term IS NULL AND n > 0").drop("term", "df"),
            both.filter("term IS NOT NULL").select("term", "df"))


class Block:
    """The items of one block of queries: their terms, weights and thresholds."""

    def __init__(self, rows: list, width: int = WIDTH) -> None:
        self.terms = [[(bytes(t["term"]), int(t["w"]), int(t["times"])) for t in r["terms"]] for r in rows]
        hits: dict[int, Counter] = {}
        for i, ts in enumerate(self.terms):
            for t, w, times in ts:
                hits.setdefault(zlib.crc32(t) % width, Counter())[i] += w * times
        self.coords = np.array(sorted(hits), dtype=np.int64)
        self.start = np.cumsum([0, *(len(hits[c]) for c in self.coords)])
        self.item = np.array([i for c in self.coords for i in hits[c]], dtype=np.int64)
        self.weight = np.array([w for c in self.coords for w in hits[c].values()], dtype=np.float64)
        self.slot = np.full(width, -1, dtype=np.int64)
        self.slot[self.coords] = np.arange(len(self.coords))

    def bounds(self, coords: list[bytes], freqs: list[bytes], m: np.ndarray) -> np.ndarray:
        """Upper bounds, documents by items. Whole numbers in doubles; beyond 2^52 rounded up."""
        items, sizes = len(self.terms), np.array([len(f) for f in freqs])
        doc = np.repeat(np.arange(len(sizes)), sizes)
        slot = self.slot[np.frombuffer(b"".join(coords), dtype="<u2")]
        hit = slot >= 0
        doc, slot = doc[hit], slot[hit]
        part = impact(FREQUENCY[np.frombuffer(b"".join(freqs), dtype="u1")[hit]], m[doc]).astype(np.float64)
        reps = self.start[slot + 1] - self.start[slot]
        sums = np.zeros(len(sizes) * items)
        # In portions: a coordinate of a common term belongs to many items.
        done = np.cumsum(reps)
        cut = np.searchsorted(done, np.arange(PORTION, (done[-1] if len(done) else 0) + PORTION, PORTION), side="right")
        for i, j in zip(np.concatenate([[0], cut]), cut):
            r, s = reps[i:j], slot[i:j]
            ends = np.cumsum(r)
            at = np.arange(r.sum()) + np.repeat(self.start[s] - ends + r, r)
            sums += np.bincount(np.repeat(doc[i:j], r) * items + self.item[at],
                                np.repeat(part[i:j], r) * self.weight[at], len(sums))
        sums[sums > 2 ** 52] *= 1 + 1e-9
        return sums.reshape(len(sizes), items)


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _bounded(batches: Iterator[pa.RecordBatch], block: Block, floor: np.ndarray, floor_id: np.ndarray,
             best: int | None) -> Iterator[pa.RecordBatch]:
    """(item, bound, hash, doc_id) of the sketches whose bound is above an item's floor (or equal to it
    with an id that is not larger). With ``best``: only bounds that are not below the task's so many best so far."""
    items = len(block.terms)
    lead = np.zeros((best or 0, items))
    for b in _slices(batches, max(16, min(1024, CELLS // items))):
        ids = np.array([2 ** 63 - 1 if i is None else i for i in b.column(0).to_pylist()], dtype=np.int64)
        up = block.bounds(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_numpy(zero_copy_only=False))
        kept = (up > 0) & ((up > floor) | ((up == floor) & (ids[:, None] <= floor_id)))
        if best is not None:
            both = np.concatenate([lead, up])
            lead = np.partition(both, len(both) - best, axis=0)[len(both) - best:]
            kept &= up >= lead.min(axis=0)
        d, i = np.nonzero(kept)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(up[d, i].astype(np.int64)),
             b.column(1).take(pa.array(d)), b.column(0).take(pa.array(d))], names=["item", "bound", "hash", "doc_id"])


def _rescored(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[pa.RecordBatch]:
    """Exact scores (item, hash, lead, score) of whole texts for the items asked for."""
    for b in _slices(batches, 256):
        out: list[list] = [[], [], [], []]
        for lead, h, text, m, items in zip(*(c.to_pylist() for c in b.columns)):
            tf = Counter(terms(text))
            for i in items:
                score = sum(w * times * impact(tf[t], m) for t, w, times in block.terms[i] if t in tf)
                for o, v in zip(out, (i, h, lead, score)):
                    o.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(o, t) for o, t in zip(out, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            names=["item", "hash", "lead", "score"])


def _order(*first: Column) -> list[Column]:
    return [*first, F.col("doc_id").asc_nulls_last()]


def _leading(df: DataFrame, per: list[str], order: list[Column], most: int) -> DataFrame:
    """The first rows of each group; Spark limits each task's rows before the shuffle."""
    return (df.withColumn("rank", F.row_number().over(Window.partitionBy(*per).orderBy(*order)))
            .filter(F.col("rank") <= most))


def _weighted_items(items: DataFrame, counts: DataFrame, n_docs: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, terms) with each term's weight and its occurrences in the item; items with a term only."""
    low = F.translate(F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(low, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    each = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"), found.alias("f")) \
        .dropDuplicates(["item_id", "text"])
    each = written(each.select("item_id", F.xxhash64("item_id", "text").alias("key"), F.explode("f").alias("term"))
                   .groupBy("key", "item_id", "term").agg(F.count(F.lit(1)).alias("times")), "search-items")
    asked = each.select(F.col("term").cast("binary").alias("term")).distinct()
    df = counts.join(asked, "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    return (each.join(df.select(F.col("term").cast("string").alias("term"), weight.alias("w")), "term")
            .groupBy("key", "item_id").agg(F.collect_list(F.struct(F.col("term").cast("binary").alias("term"), "w", "times"))
                                           .alias("terms")))


def _search(block: Block, sketches: DataFrame, given: DataFrame, top: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each item of a block."""
    spark, items = sketches.sparkSession, len(block.terms)
    schema = "item int, bound bigint, hash bigint, doc_id bigint"

    def bounded(floor: np.ndarray, floor_id: np.ndarray, best: int | None) -> DataFrame:
        return sketches.select("doc_id", "hash", "coords", "freqs", "m").mapInArrow(
            partial(_bounded, block=block, floor=floor, floor_id=floor_id, best=best), schema)

    def texts(pairs: DataFrame) -> DataFrame:
        """Equal texts of an item as one row with its smallest ids."""
        few = _leading(pairs, ["item", "hash"], _order(), top)
        return few.groupBy("item", "hash").agg(
            F.max("bound").alias("bound"), F.min("doc_id").alias("doc_id"),
            F.sort_array(F.collect_list(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))).alias("ids"))

    def scores(chosen: DataFrame) -> DataFrame:
        """(item, hash, score) of the chosen texts."""
        wanted = written(chosen.groupBy("hash", F.col("doc_id").alias("lead"))
                         .agg(F.sort_array(F.collect_list("item")).alias("items")), "search-wanted")
        hint = F.broadcast if wanted.count() <= BROADCAST_ROWS else (lambda df: df)
        # One row of a text is enough: the first of its least id. Its length gives m.
        met = given.join(hint(wanted), (given["hash"] == wanted["hash"]) & given["doc_id"].eqNullSafe(wanted["lead"])) \
            .select("lead", wanted["hash"], "t", "items").dropDuplicates(["lead", "hash"])
        m = sketches.join(hint(wanted.select("hash")), "hash").groupBy("hash").agg(F.first("m").alias("m"))
        rows = met.join(m, "hash").select("lead", "hash", "t", "m", "items").mapInArrow(
            partial(_rescored, block=block), "item int, hash bigint, lead bigint, score bigint")
        return written(rows.select("item", "hash", "score"), "search-scores")

    def found(chosen: DataFrame, scored: DataFrame) -> DataFrame:
        """(item, doc_id, score) of scored texts, one row for each of their ids."""
        return (chosen.select("item", "hash", "ids").join(scored, ["item", "hash"])
                .select("item", F.explode("ids.doc_id").alias("doc_id"), "score").filter("score > 0"))

    def thresholds(best: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of each item's last rank; at most one row of an item is collected."""
        floor, floor_id = np.zeros(items), np.full(items, np.iinfo(np.int64).max)
        for r in best.filter(F.col("rank") == top).select("item", "score", "doc_id").collect():
            floor[r["item"]] = r["score"]
            floor_id[r["item"]] = np.iinfo(np.int64).max if r["doc_id"] is None else r["doc_id"]
        return floor, floor_id

    def ranked(rows: DataFrame) -> DataFrame:
        return written(_leading(rows.select("item", "doc_id", "score"), ["item"], _order(F.desc("score")), top), "search-best")

    by_bound = _order(F.desc("bound"))
    start = written(texts(bounded(np.zeros(items), np.full(items, -1, dtype=np.int64), FIRST_ROUND)), "search-start")
    start = written(_leading(start, ["item"], by_bound, FIRST_ROUND).drop("rank"), "search-first")
    scored = scores(start)
    floor, floor_id = thresholds(ranked(found(start, scored)))
    # All that reaches the threshold, with all its ids: the first round may have seen a
    # text in some tasks only.
    every = written(texts(bounded(floor, floor_id, None)), "search-every")
    best = ranked(found(every, scored))
    left = written(every.join(scored, ["item", "hash"], "left_anti"), "search-left")
    most = FIRST_ROUND
    while not left.isEmpty():
        most *= GROWTH
        taken = written(_leading(left, ["item"], by_bound, most).drop("rank"), "search-round")
        best = ranked(best.drop("rank").unionByName(found(taken, scores(taken))))
        floor, floor_id = thresholds(best)
        floors = spark.createDataFrame(list(zip(range(items), (int(f) for f in floor), (int(i) for i in floor_id))),
                                       "item int, floor bigint, floor_id bigint")
        # At most one row for each item of a block.
        over = (F.col("bound") > F.col("floor")) | ((F.col("bound") == F.col("floor"))
                                                    & (F.coalesce("doc_id", F.lit(2 ** 63 - 1)) < F.col("floor_id")))
        left = written(left.join(taken.select("item", "hash"), ["item", "hash"], "left_anti")
                       .join(F.broadcast(floors), "item").filter(over).drop("floor", "floor_id"), "search-left")
    return best


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of each item; see the contract of op11.
    Ids of documents are whole numbers. A smaller ``width`` makes sketches smaller and bounds looser."""
    spark = docs.sparkSession
    sketches, counts = build_index(docs, id_col, text_col, width)
    total = sketches.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_docs, n_terms = int(total[0]), int(total[1] or 0)
    sketches = sketches.withColumn("m", F.expr(f"25 + (75 * n * {n_docs}L) div {max(1, n_terms)}L"))
    asked = written(_weighted_items(items, counts, n_docs, item_col, item_text), "search-asked")
    volume = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-int(volume) // BLOCK_TERMS)
    given, out = _given(docs, id_col, text_col), None
    for k in range(blocks):
        rows = asked.filter(F.pmod("key", F.lit(blocks)) == k).orderBy("key").collect()
        if not rows:
            continue
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                      f"item int, item_id {dict(items.dtypes)[item_col]}")
        best = _search(Block(rows, width), sketches, given, top).join(F.broadcast(names), "item") \
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = spark.createDataFrame([], f"item_id {dict(items.dtypes)[item_col]}, rank int, doc_id bigint, score bigint")
    return out
