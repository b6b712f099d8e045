"""Line dedup by an exact set-similarity join: the words of a line are ordered
by rarity, lines that share a word of their prefixes are candidates, length,
positional and bitmap filters thin them, the exact Jaccard similarity of the
word sets decides, and later matches are removed. Words are counted, ordered and
listed with numpy in Arrow tasks; Spark does the shuffles and the joins (the
README gives the figures of the native form, which did not meet the limits).

A line is its set of lower-cased words, named by a 64-bit hash of its text. Two
sets of a and b words reach the similarity t only if they share t / (1 + t) *
(a + b) words, so the first word that they share, in any order common to all
lines, stands early in both. The order is by a sketch: occurrences over all
documents, summed on WIDTH hashed counters in whole, so that a word is never
counted too low. The ranks of the counters, a byte each, go to the tasks; their
number is fixed.

A word's list holds the lines with the word in their prefix. A word that occurs
fewer than HOT times has a list that fits one task; the list of any other is
split by the names of its lines. Of lists up to ``short_list`` lines all pairs are
compared at once. Of a longer list every line meets the first. One minus the
Jaccard similarity is a metric, so lines within half the allowed distance of one
set (a ball) all match each other: pairs of one ball are counted by the lines'
places in it. The set is that of the words which most matches of the list's first
have, or else a line. All other pairs of the list are compared in cells of two blocks of
about BLOCK lines; a ball that fills blocks of its own has no cells among them. A short
list most of whose pairs may match counts as a long one. A cell gives a row a line, with
the number of its links and a line that it is connected to, whatever the number of pairs.
So close copies by the thousand cost a comparison each, and no line loses a
link."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from xxhash import xxh64_intdigest

from .common import connected_components, own_names, plain, plain_names, row_key, ship, written

MIN_SIMILARITY = 0.8
#: Counters of the sketch of occurrences.
WIDTH = 1 << 20
#: Ranks of a counter per doubling of it.
STEPS = 6
#: Occurrences from which a word's list is split between tasks.
HOT = 1 << 16
#: Lists of up to so many lines are compared pair by pair at once.
SHORT_LIST = 512
#: Pairs a line that may match, from which a short list is taken as a longer one.
DENSE = 16
#: Lines of a block of a longer list.
BLOCK = 2048
#: Bytes of a side that may be broadcast; above, Spark shuffles.
BROADCAST_BYTES = 48 << 20
#: Documents, and postings, that a task works on at a time.
PIECE, BUFFER = 2000, 100_000
#: Rows of lines with their word sets, and pairs of them, that a task works on at a time.
SETS, PAIRS = 10_000, 20_000
_SPACES = r"[\x20\x09-\x0D]+"
_NO_ID = (1 << 63) - 1
LISTED = "tok long, salt int, k long, n int, rn int, bits long"
MET = "listed boolean, tok long, k long, n int, rn int, bits long, o_k long"
MET_IN_CELL = "tok long, one int, two int, k long, met array<long>"


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), _SPACES), "")


def _named(docs: DataFrame, doc_id: str, text: str) -> tuple[Column, Column]:
    """(doc, mark): ``doc`` orders the documents (null ids last); ``mark`` tells
    documents of one id apart, and is 0 where no id is used twice."""
    doc = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID))
    twice = not docs.groupBy(doc.alias("doc")).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    mark = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 33) if twice else F.lit(0).cast("bigint")
    return doc, mark


def _prepared(docs: DataFrame) -> DataFrame:
    """(doc, mark, text) of documents (doc_id, text)."""
    doc, mark = _named(docs, "doc_id", "text")
    return docs.select(doc.alias("doc"), mark.alias("mark"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, part, line): the lines with words of prepared documents; ``part``
    orders the lines of a document, with its mark in the low bits."""
    cut = docs.select("doc", "mark", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return cut.filter(F.regexp_like("line", F.lit(r"[^\x20\x09-\x0D]"))).select(
        "doc", F.shiftleft(F.col("no").cast("bigint"), 31).bitwiseOR(F.col("mark")).alias("part"), "line")


def _needed(a: Column, b: Column, similarity: float) -> Column:
    """Least number of words that sets of a and b words share at a similarity."""
    return F.ceil(F.lit(similarity / (1 + similarity)) * (a + b) - F.lit(1e-9))


def _named_lines(docs: DataFrame) -> DataFrame:
    return _lines(docs).select("doc", "part", F.xxhash64("line").alias("k"), "line")


def _small(df: DataFrame) -> DataFrame:
    """A written table, broadcast if its counted rows are few bytes."""
    return F.broadcast(df) if df.count() * (16 + 8 * len(df.columns)) <= BROADCAST_BYTES else df


def _words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, hash): of each word of lower-cased texts the row and the place of
    the word in ``hash``, the hashes of the different words."""
    words = pc.ascii_split_whitespace(texts)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:  # spaces at the ends of a text
        real = word != blank
        row, word = row[real], word[real]
    return row, word, np.fromiter(map(xxh64_intdigest, names), dtype=np.uint64, count=len(names))


def _count(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(width, dtype=np.int64)
    for batch in batches:
        for start in range(0, len(batch), PIECE):
            _, word, h = _words_of(batch.column(0).slice(start, PIECE))
            np.add.at(total, (h % np.uint64(width)).astype(np.int64), np.bincount(word, minlength=len(h)))
    place = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(total[place])], ["place", "n"])


def rarity(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """The rank of each counter of the sketch, a byte that grows with its sum."""
    sums = docs.select(F.lower("text").alias("text")).mapInArrow(partial(_count, width=width), "place int, n long")
    table = sums.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(width, dtype=np.int64)
    counts[table["place"].to_numpy()] = table["n"].to_numpy()
    return np.minimum(255, np.floor(STEPS * np.log2(1 + counts))).astype(np.uint8)


def _post(batches: Iterator[pa.RecordBatch], ranks: np.ndarray, similarity: float, hot: int) -> Iterator[pa.RecordBatch]:
    # At most so many lines have a word of a rank, and so many tasks share its list.
    most = 2.0 ** ((np.arange(256) + 1) / STEPS)
    shares = np.where(most > hot, np.ceil(most / hot), 0).astype(np.int64)
    for batch in batches:
        k, first = np.unique(batch.column("k").to_numpy(), return_index=True)
        row, word, h = _words_of(batch.column("line").take(pa.array(first)))
        rank = ranks[h % np.uint64(len(ranks))]
        by_rarity = np.lexsort((h, rank))
        order = np.empty(len(h), dtype=np.int64)
        order[by_rarity] = np.arange(len(h))
        key = np.sort((row << 32) | order[word])  # np.unique took 196 ms for 8 (numpy 2.3)
        key = key[np.append(True, key[1:] != key[:-1])[:len(key)]]
        row, word = key >> 32, by_rarity[key & 0xFFFFFFFF]
        n = np.bincount(row, minlength=len(k))
        start = np.cumsum(n) - n
        rn = np.arange(len(key)) - start[row]
        bits = np.bitwise_xor.reduceat(np.uint64(1) << ((h[word] >> np.uint64(40)) & np.uint64(63)), start) \
            if len(key) else np.zeros(0, dtype=np.uint64)
        keep = rn <= (n - np.ceil(similarity * n - 1e-9))[row]
        row, word, rn = row[keep], word[keep], rn[keep]
        share = shares[rank[word]]
        salt = np.where(share > 0, (k[row] & 0x7FFFFFFF) % np.maximum(share, 1), -1)
        yield pa.RecordBatch.from_arrays([
            pa.array(h[word].view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(k[row]),
            pa.array(n[row].astype(np.int32)), pa.array(rn.astype(np.int32)), pa.array(bits[row].view(np.int64))],
            ["tok", "salt", "k", "n", "rn", "bits"])


def postings(docs: DataFrame, similarity: float, hot: int = HOT) -> DataFrame:
    """(tok, salt, k, n, rn, bits): the prefix words of the lines k, with the number
    of words of the line, the place of the word in their order and a parity bitmap of
    the set. ``salt`` is -1 but for the shares of a frequent word's list. A line is
    repeated at most once per batch of rows."""
    ship(docs)
    ranks = rarity(docs)
    lines = _named_lines(docs).select("k", F.lower("line").alias("line"))
    return lines.mapInArrow(partial(_post, ranks=ranks, similarity=similarity, hot=hot), LISTED)


def _may_match(n, rn, bits, o_n, o_rn, o_bits, similarity: float):  # noqa: ANN001, ANN202 - arrays
    """Length, positional and bitmap filters of pairs of postings of a word, for the
    list of the first word that both lines have."""
    need = np.ceil(similarity / (1 + similarity) * (n + o_n) - 1e-9)
    # What stands before the word in either line is in that line only.
    ok = (np.minimum(n, o_n) >= similarity * np.maximum(n, o_n) - 1e-9) & (np.minimum(n - rn, o_n - o_rn) >= need)
    # Of a negative number numpy would count the bits of its absolute value.
    return ok & (np.bitwise_count((bits ^ o_bits).view(np.uint64)) <= n + o_n - 2 * need)


def _passes(similarity: float) -> Column:
    """``_may_match`` of a posting and one named o_."""
    n, o_n = F.col("n"), F.col("o_n")
    need = _needed(n, o_n, similarity)
    return ((F.least(n, o_n) >= F.lit(similarity) * F.greatest(n, o_n) - F.lit(1e-9))
            & (F.least(n - F.col("rn"), o_n - F.col("o_rn")) >= need)
            & (F.bit_count(F.col("bits").bitwiseXOR(F.col("o_bits"))) <= n + o_n - 2 * need))


def _new(cols: dict, keys: list[str]) -> np.ndarray:
    """Whether a row of sorted columns is the first with its keys."""
    new = np.zeros(len(cols[keys[0]]), dtype=bool)
    new[:1] = True
    for c in keys:
        new[1:] |= cols[c][1:] != cols[c][:-1]
    return new


def _whole(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Sorted rows as tables of ``rows`` or more; a run of equal keys is never cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < rows:
            continue
        table = pa.Table.from_batches(held)
        start = np.flatnonzero(_new({c: table[c].to_numpy() for c in keys}, keys))
        if len(start) > 1:
            yield table.slice(0, start[-1])
            held = table.slice(start[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Sorted rows as columns with the starts and lengths of the runs of equal keys."""
    for table in _whole(batches, keys, BUFFER):
        cols = {c: table[c].to_numpy() for c in table.column_names}
        start = np.flatnonzero(_new(cols, keys))
        yield cols, start, np.diff(np.append(start, len(table)))


def _met(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    one = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, dtype=np.int64)
    two = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, dtype=np.int64)
    return one, two


def _meet(batches: Iterator[pa.RecordBatch], similarity: float, short_list: int) -> Iterator[pa.RecordBatch]:
    for cols, _, _ in _runs(batches, ["tok", "salt"]):
        tok, salt, k = cols["tok"], cols["salt"], cols["k"]
        again = np.zeros(len(k), dtype=bool)
        again[1:] = (tok[1:] == tok[:-1]) & (salt[1:] == salt[:-1]) & (k[1:] == k[:-1])
        cols = {c: v[~again] for c, v in cols.items()}
        tok, salt, k = cols["tok"], cols["salt"], cols["k"]
        new = np.ones(len(k), dtype=bool)
        new[1:] = (tok[1:] != tok[:-1]) | (salt[1:] != salt[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(k)))
        of = np.cumsum(new) - 1
        end = (start + size)[of]
        long_list = (size[of] > short_list) | (salt >= 0)
        n, rn, bits = cols["n"], cols["rn"], cols["bits"]
        one, pairs, step = np.flatnonzero(~long_list), [], 1
        while len(one := one[end[one] > one + step]):
            two = one + step
            ok = _may_match(n[one], rn[one], bits[one], n[two], rn[two], bits[two], similarity)
            pairs.append((one[ok], two[ok]))
            step += 1
        a, b = _met(pairs)
        dense = np.bincount(of[a], minlength=len(size)) > DENSE * size
        long_list |= dense[of]
        listed = ~dense[of[a]]
        a, b = k[a[listed]], k[b[listed]]
        none = pa.nulls(len(a), pa.int64())
        narrow = pa.nulls(len(a), pa.int32())
        names = ["listed", "tok", "k", "n", "rn", "bits", "o_k"]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(a), dtype=bool)), none, pa.array(a), narrow, narrow, none,
                                          pa.array(b)], names)
        m = int(long_list.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(m, dtype=bool)), *[pa.array(cols[c][long_list]) for c in ("tok", "k", "n", "rn", "bits")],
             pa.nulls(m, pa.int64())], names)


def _cross(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for cols, start, size in _runs(batches, ["tok", "one", "two"]):
        for s, m in zip(start, size):
            run = {c: v[s:s + m] for c, v in cols.items()}
            left = np.flatnonzero(run["side"] == 0)
            right = np.flatnonzero(run["side"] == 1)
            same = run["one"][0] == run["two"][0]
            right = left if same else right
            rows, met = max(1, (1 << 20) // max(1, len(right))), []
            for i in range(0, len(left), rows):
                a, b = left[i:i + rows, None], right[None, :]
                ok = (run["ball"][a] != run["ball"][b]) | (run["ball"][a] == 0)
                if same:
                    ok &= a < b
                ok &= _may_match(*[run[c][a] for c in ("n", "rn", "bits")], *[run[c][b] for c in ("n", "rn", "bits")], similarity)
                x, y = np.nonzero(ok)
                met.append((left[i:i + rows][x].astype(np.int32), right[y].astype(np.int32)))
            x, y = _met(met)
            if not len(x):
                continue
            # A row for each line of a pair; x ascends, so the pairs lie in the order of the rows.
            lines = np.unique(np.concatenate([x, y]))
            ends = np.searchsorted(x, lines, side="right")
            yield pa.RecordBatch.from_arrays([
                *[pa.array(np.full(len(lines), run[c][0])) for c in ("tok", "one", "two")], pa.array(run["k"][lines]),
                pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(run["k"][y]))],
                ["tok", "one", "two", "k", "met"])


class _Lists:
    """A list of numbers for each row of an Arrow column."""

    def __init__(self, column: pa.ChunkedArray) -> None:
        lists = pa.concat_arrays(column.chunks)
        offsets = lists.offsets.to_numpy()
        self.start, self.size = offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64)
        self.values = lists.values.to_numpy()
        self.names, self.code = np.unique(self.values, return_inverse=True)
        row, at = self.of(np.arange(len(self.size)))
        self.key = np.sort(row * len(self.names) + self.code[at])

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(i, at): the places in ``values`` of the lists of ``rows[i]``, in order."""
        size = self.size[rows]
        i = np.repeat(np.arange(len(rows)), size)
        return i, np.arange(len(i)) + np.repeat(self.start[rows] - (np.cumsum(size) - size), size)

    def _in(self, row: np.ndarray, code: np.ndarray) -> np.ndarray:
        key = row * len(self.names) + code
        return self.key[np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)] == key

    def holds(self, row: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Whether the list of a row has a number."""
        if not len(self.key):
            return np.zeros(len(row), dtype=bool)
        code = np.minimum(np.searchsorted(self.names, number), len(self.names) - 1)
        return (self.names[code] == number) & self._in(row, code)

    def shared(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For two rows each, how many numbers of the first list the second has, and the first such."""
        i, at = self.of(x)
        both = self._in(y[i], self.code[at]) if len(self.key) else np.zeros(0, dtype=bool)
        i, at = i[both], at[both]
        first = np.zeros(len(x), dtype=np.int64)
        first[i[::-1]] = self.values[at[::-1]]
        return np.bincount(i, minlength=len(x)), first


def _trees(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each row the least row that the pairs (x, y) connect it to; every row is an x."""
    root = np.arange(x.max(initial=-1) + 1)
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _count_links(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    cells = ["tok", "one", "two"]
    for table in _whole(batches, cells, SETS):
        cols = {c: table[c].to_numpy() for c in (*cells, "k", "doc", "part")}
        k, cell = cols["k"], np.cumsum(_new(cols, cells)) - 1
        met, sets, near, lists = (_Lists(table[c]) for c in ("met", "set", "near", "lists"))
        names = np.unique(k)
        key = cell * len(names) + np.searchsorted(names, k)
        total, rows = np.zeros(len(k), dtype=np.int64), np.arange(len(k))
        root = rows
        piece = np.cumsum(met.size) // PAIRS
        for p in np.unique(piece):
            x, at = met.of(mine := rows[piece == p])
            x = mine[x]
            y = np.searchsorted(key, cell[x] * len(names) + np.searchsorted(names, met.values[at]))
            shared, _ = sets.shared(x, y)
            ok = shared >= similarity * (sets.size[x] + sets.size[y] - shared) - 1e-9
            x, y = x[ok], y[ok]
            root = _trees(np.append(x, rows), np.append(y, root))
            # A pair that meets in several lists counts in that of the first word, and not if it is listed.
            own = (lists.shared(x, y)[1] == cols["tok"][x]) & ~near.holds(x, k[y]) & ~near.holds(y, k[x])
            x, y = x[own], y[own]
            earlier = (cols["doc"][x] < cols["doc"][y]) | ((cols["doc"][x] == cols["doc"][y]) & (cols["part"][x] < cols["part"][y]))
            total += np.bincount(np.where(earlier, y, x), minlength=len(k))
        out = (root != rows) | (total > 0)
        yield pa.RecordBatch.from_arrays([pa.array(k[out]), pa.array(k[root[out]]), pa.array(total[out])], ["k", "o_k", "more"])


def _in_cells(known: DataFrame, similarity: float, block: int) -> DataFrame:
    """(tok, one, two, k, met): the lines of a cell with those that they may match and that
    are not of their ball, of the long lists (tok, k, n, rn, bits, ball). A list is cut into
    blocks by hash, a ball of a block or more into blocks of its own; any two blocks meet in
    a cell, but those of one ball."""
    sizes = written(known.groupBy("tok", "ball").agg(F.count("*").alias("m")), "list-balls")
    own = sizes.select("tok", "ball", F.when(F.col("m") >= block, F.col("ball")).otherwise(0).alias("grp"), "m")
    groups = own.groupBy("tok", "grp").agg(F.ceil(F.sum("m") / block).alias("blocks"))
    groups = written(groups, "list-groups")
    blocks = groups.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    # A row per block of a list.
    blocks = written(blocks.withColumn("no", F.row_number().over(Window.partitionBy("tok").orderBy("grp", "b"))), "list-blocks")
    other = blocks.select("tok", F.col("no").alias("two"), F.col("grp").alias("o_grp"))
    cells = written(blocks.join(other, "tok").filter("no <= two and (grp <> o_grp or grp = 0)").select(
        "tok", F.col("no").alias("one"), "two"), "list-cells")
    ends = cells.select("tok", F.col("one").alias("no"), "one", "two", F.lit(0).alias("side")).unionByName(
        cells.filter("one <> two").select("tok", F.col("two").alias("no"), "one", "two", F.lit(1).alias("side")))
    big = written(own.filter("grp <> 0").select("tok", "ball", "grp"), "list-own")
    placed = (known.join(_small(big), ["tok", "ball"], "left").withColumn("grp", F.coalesce("grp", F.lit(0)))
              .join(_small(groups), ["tok", "grp"]).withColumn("b", F.pmod(F.xxhash64("k", "tok"), "blocks"))
              .join(_small(blocks.select("tok", "grp", "b", "no")), ["tok", "grp", "b"]))
    dealt = placed.join(_small(written(ends, "list-ends")), ["tok", "no"]).select(
        "tok", "one", "two", "side", "k", "n", "rn", "bits", "ball")
    return (dealt.repartition("tok", "one", "two").sortWithinPartitions("tok", "one", "two")
            .mapInArrow(partial(_cross, similarity=similarity), MET_IN_CELL))


def _parity(words: int) -> Column:
    """Parity bitmaps of the set, ``words`` numbers of 64 bits: bits of two sets
    that differ bound from below how many words only one of them has."""
    return F.array(*[F.expr(f"aggregate(filter(set, h -> (h & {words - 1}L) = {i}L), 0L, "
                            "(a, h) -> a ^ shiftleft(1L, cast(shiftrightunsigned(h, 8) & 63 as int)))")
                     for i in range(words)])


def _sets(docs: DataFrame, firsts: DataFrame, lines: DataFrame) -> DataFrame:
    """(k, set) of the lines (k): the hashes of their words, from the first occurrence, read again."""
    ends = lines.join(firsts.select("k", F.col("f_doc").alias("doc"), F.col("f_part").alias("part")), "k")
    return _named_lines(docs).join(_small(written(ends, "pair-lines")), ["k", "doc", "part"]).select(
        "k", F.array_distinct(F.transform(_words(F.col("line")), lambda w: F.xxhash64(w))).alias("set")).dropDuplicates(["k"])


def _verified(docs: DataFrame, firsts: DataFrame, pairs: DataFrame, heads: DataFrame,
              similarity: float) -> tuple[DataFrame, DataFrame]:
    """The pairs (k, o_k) whose sets reach the similarity, with ``tight``: whether they
    are within half the allowed distance; and the word sets (k, set) of the lines of the pairs and
    of the heads. Bitmaps are compared first, so that the word sets are shuffled for few pairs but
    the true ones."""
    pairs = written(pairs, "line-pairs")
    ends = pairs.select("k").union(pairs.select("o_k")).union(heads.select("o_k")).distinct()
    sets = written(_sets(docs, firsts, ends).select("*", F.size("set").alias("n"), _parity(4).alias("bits")), "pair-sets")

    def attach(p: DataFrame, *columns: str) -> DataFrame:
        other = sets.select(F.col("k").alias("o_k"), *[F.col(c).alias(f"o_{c}") for c in columns])
        return p.join(sets.select("k", *columns), "k").join(other, "o_k")

    differ = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("o_bits")[i])) for i in range(1, 4)),
                 F.bit_count(F.col("bits")[0].bitwiseXOR(F.col("o_bits")[0])))
    close = attach(pairs, "n", "bits").filter(
        differ <= F.col("n") + F.col("o_n") - 2 * _needed(F.col("n"), F.col("o_n"), similarity))
    close = written(close.select("k", "o_k"), "close-pairs")
    shared = F.size(F.array_intersect("set", "o_set"))
    union = F.size("set") + F.size("o_set") - shared
    near = written(attach(close, "set").filter(shared >= F.lit(similarity) * union - F.lit(1e-9))
                   .select("k", "o_k", (shared >= F.lit((1 + similarity) / 2) * union).alias("tight")), "line-links")
    return near, sets.select("k", "set")


def _balls(sets: DataFrame, near: DataFrame, heads: DataFrame, similarity: float) -> DataFrame:
    """(k, ball): the lines of a ball are within half the allowed distance of one set, so they
    match each other. Of lines that match the first of a long list (its head) it is the set of the
    words that most of them have: copies of a text lie around it, though they may be too far
    from the head. Any other line's ball is named by the least line that is tight to it."""
    tight = near.filter("tight").groupBy(F.col("o_k").alias("k")).agg(F.min("k").alias("c")).select(
        "k", F.xxhash64("c").alias("ball"))
    first = written(heads.select(F.col("o_k").alias("k")).distinct(), "list-firsts")
    if first.isEmpty():
        return tight
    members = near.join(_small(first), "k").select(F.col("o_k").alias("k"), F.col("k").alias("c")).unionByName(
        first.withColumn("c", F.col("k"))).groupBy("k").agg(F.min("c").alias("c"))
    members = written(members, "list-members")
    sets = written(sets.join(_small(members), "k"), "member-sets")
    words = sets.select("c", F.explode("set").alias("h")).groupBy("c", "h").agg(F.count("*").alias("n"))
    sizes = written(sets.groupBy("c").agg(F.count("*").alias("m")), "member-counts")
    words = written(words.join(_small(sizes), "c").filter("2 * n > m").select("c", "h"), "center-words")
    centers = words.groupBy("c").agg(F.collect_list("h").alias("center"))
    if words.count() * 32 <= BROADCAST_BYTES:
        centers = F.broadcast(centers)
    shared = F.size(F.array_intersect("set", "center"))
    union = F.size("set") + F.size("center") - shared
    within = written(sets.join(centers, "c").filter(shared >= F.lit((1 + similarity) / 2) * union).select(
        "k", F.xxhash64("c", F.lit("center")).alias("ball")), "center-balls")
    return within.unionByName(tight.join(_small(within), "k", "left_anti"))


def _in_long_lists(docs: DataFrame, firsts: DataFrame, known: DataFrame, near: DataFrame, similarity: float,
                   block: int) -> DataFrame:
    """(k, o_k, more): lines of the long lists, connected to o_k by links; ``more`` sums up to the
    number of links with earlier lines that are not in ``near`` and not of one ball."""
    cells = written(_in_cells(known, similarity, block), "line-cells")
    ends = _small(written(cells.select("k").distinct(), "cell-ends"))
    sets = _sets(docs, firsts, ends)
    # The later line of a listed pair, never the first of a long list, holds the other.
    listed = near.join(ends.withColumnRenamed("k", "o_k"), "o_k").groupBy(F.col("o_k").alias("k")).agg(
        F.collect_set("k").alias("near"))
    lists = known.join(ends, "k").groupBy("k").agg(F.sort_array(F.collect_list(F.struct("rn", "tok"))).alias("l")).select(
        "k", F.col("l.tok").alias("lists"))
    lines = sets.join(firsts.withColumnsRenamed({"f_doc": "doc", "f_part": "part"}), "k").join(lists, "k").join(
        listed, "k", "left").withColumn("near", F.coalesce("near", F.array().cast("array<bigint>")))
    return (cells.join(written(lines, "cell-lines"), "k").repartition("tok", "one", "two")
            .sortWithinPartitions("tok", "one", "two", "k")
            .mapInArrow(partial(_count_links, similarity=similarity), "k long, o_k long, more long"))


def links(docs: DataFrame, firsts: DataFrame, similarity: float = MIN_SIMILARITY, short_list: int = SHORT_LIST,
          hot: int = HOT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(k, o_k, inside, more) and (k, ball) of prepared documents. The links between distinct
    lines are the verified ones in the first table that are not ``inside``, as many again with
    earlier lines as ``more`` sums up to for k, and all pairs of lines of one ball. Two matching
    lines are connected through the first table, whose rows grow as the lines do."""
    listed = postings(docs, similarity, hot)
    met = written(listed.repartition("tok", "salt").sortWithinPartitions("tok", "salt", "k").mapInArrow(
        partial(_meet, similarity=similarity, short_list=short_list), MET), "line-meetings")
    long_lists = met.filter("listed").select("tok", "k", "n", "rn", "bits")
    heads = long_lists.groupBy("tok").agg(F.min(F.struct("k", "n", "rn", "bits")).alias("h"))
    heads = written(heads.select("tok", *[F.col(f"h.{c}").alias(f"o_{c}") for c in ("k", "n", "rn", "bits")]), "line-heads")
    to_head = long_lists.join(_small(heads), "tok").filter((F.col("o_k") < F.col("k")) & _passes(similarity)) \
        .select(F.col("o_k").alias("k"), F.col("k").alias("o_k"))
    near, sets = _verified(docs, firsts, met.filter(~F.col("listed")).select("k", "o_k").unionByName(to_head).distinct(),
                           heads, similarity)
    balls = written(_balls(sets, near, heads, similarity), "line-balls")
    known = written(long_lists.join(_small(balls), "k", "left").withColumn("ball", F.coalesce("ball", F.lit(0))), "line-lists")
    other = balls.withColumnsRenamed({"k": "o_k", "ball": "o_ball"})
    both = near.join(_small(balls), "k", "left").join(_small(other), "o_k", "left").select(
        "k", "o_k", F.coalesce(F.col("ball") == F.col("o_ball"), F.lit(False)).alias("inside"),
        F.lit(0).cast("bigint").alias("more"))
    rest = _in_long_lists(docs, firsts, known, near, similarity, block)
    return both.unionByName(rest.select("k", "o_k", F.lit(True).alias("inside"), "more")), balls


def _places(balls: DataFrame) -> DataFrame:
    """(k, place) of (k, ball, doc, part): the number of earlier lines of a line's ball. Ranges of
    the lines' order are numbered each by itself, so a large ball is no one task."""
    parts = int(balls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(balls.repartitionByRange(parts, "ball", "doc", "part")
                     .withColumn("range", F.spark_partition_id()), "ball-ranges")
    per_range = ranged.groupBy("ball", "range").agg(F.count("*").alias("n"))
    starts = written(per_range.select("ball", "range", (F.sum("n").over(
        Window.partitionBy("ball").orderBy("range")) - F.col("n")).alias("start")), "ball-starts")
    own = F.row_number().over(Window.partitionBy("ball", "range").orderBy("doc", "part"))
    return ranged.withColumn("own", own).join(_small(starts), ["ball", "range"]).select(
        "k", (F.col("start") + F.col("own") - 1).alias("place"))


def line_classes(docs: DataFrame, similarity: float = MIN_SIMILARITY, short_list: int = SHORT_LIST,
                 hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """One row per line with words: doc_id, line_no (from 0), class_doc_id and
    class_line_no (the first line that a chain of matches and equal lines
    reaches), n_links (earlier matches of the line's text, equal texts counted
    once) and
    ``removed``: whether an earlier line is equal or a match.

    Lines are ordered by doc_id (null last) and place. Null, empty and blank
    lines are no lines here and always stay. Rows that repeat a document repeat
    its lines, all but the first removed. Other columns are ignored.
    """
    placed = _placed(_prepared(docs), similarity, short_list, hot, block)
    number = lambda c: F.shiftrightunsigned(c, 31).cast("int")
    ident = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    out = placed.select(
        ident("doc").alias("doc_id"), number(F.col("part")).alias("line_no"),
        F.coalesce(ident("c_doc"), ident("f_doc")).alias("class_doc_id"),
        number(F.coalesce("c_part", "f_part")).alias("class_line_no"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), _repeats().alias("removed"), "times")
    return out.withColumn("time", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).withColumn(
        "removed", F.col("removed") | (F.col("time") > 1)).drop("time", "times")


def _repeats() -> Column:
    """Of the rows of ``_placed``: the line equals or matches an earlier one."""
    first = (F.col("doc") == F.col("f_doc")) & (F.col("part") == F.col("f_part"))
    return ~first | (F.coalesce("n_links", F.lit(0)) > 0)


def _placed(docs: DataFrame, similarity: float = MIN_SIMILARITY, short_list: int = SHORT_LIST,
            hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """A row for each line of prepared documents (equal rows once, counted in ``times``): its
    place (doc, part), the first of its equal lines, its class and its number of links."""
    lines = written(_named_lines(docs).select("doc", "part", "k"), "line-places")
    firsts = written(lines.groupBy("k").agg(F.min(F.struct("doc", "part")).alias("f")).select(
        "k", F.col("f.doc").alias("f_doc"), F.col("f.part").alias("f_part")), "line-firsts")
    found, balls = links(docs, firsts, similarity, short_list, hot, block)
    found = written(found, "all-line-links")
    roots = written(connected_components(found.select(F.col("k").alias("a"), F.col("o_k").alias("b")))
                    .withColumnRenamed("node", "k").join(firsts, "k"), "line-roots")
    first = roots.groupBy("root").agg(F.min(F.struct("f_doc", "f_part")).alias("f")).select(
        "root", F.col("f.f_doc").alias("c_doc"), F.col("f.f_part").alias("c_part"))
    at = roots.select("k", "f_doc", "f_part")
    o_at = at.withColumnsRenamed({"k": "o_k", "f_doc": "o_doc", "f_part": "o_part"})
    later = (found.filter(~F.col("inside")).join(_small(at), "k").join(_small(o_at), "o_k")
             .select(F.when(F.expr("o_doc < f_doc or (o_doc = f_doc and o_part < f_part)"), F.col("k"))
                     .otherwise(F.col("o_k")).alias("k"), F.lit(1).cast("bigint").alias("more")))
    apart = later.unionByName(found.filter("more > 0").select("k", "more")).groupBy("k").agg(F.sum("more").alias("apart"))
    within = _places(balls.join(at.withColumnsRenamed({"f_doc": "doc", "f_part": "part"}), "k"))
    state = written(roots.join(first, "root").join(apart, "k", "left").join(within, "k", "left").select(
        "k", "c_doc", "c_part", (F.coalesce("apart", F.lit(0)) + F.coalesce("place", F.lit(0))).alias("n_links")), "line-results")
    # Equal rows have equal places: of these, all but one are removed.
    again = lines.groupBy("doc", "part", "k").agg(F.count("*").alias("times"))
    return again.join(firsts.join(_small(state), "k", "left"), "k")


def remove_repeats(docs: DataFrame, similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the removed lines cut out of the texts; all rows
    and columns stay. Of rows with one id and text, one keeps its lines (rows that are
    equal in every column are told apart by counting) and the others lose all lines with
    words. Rows without an id are cut like any other, texts of one id each by its own
    lines. Null texts stay null; blank lines stay."""
    own = plain_names(docs)
    doc_id, text = plain(docs, "doc_id"), plain(docs, "text")
    lines = _placed(_prepared(own.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))), similarity)
    gone = lines.filter(_repeats()).groupBy("doc", F.col("part").bitwiseAND((1 << 31) - 1).alias("mark")).agg(
        F.collect_set(F.shiftrightunsigned("part", 31).cast("int")).alias("gone"))
    doc, mark = _named(own, doc_id, text)
    rows = own.withColumn("doc", doc).withColumn("mark", mark).withColumn("key", row_key(own))
    # Equal rows are one with a count, so that a large group of copies is no task's burden.
    counted = written(rows.groupBy("doc", "mark", "key").agg(F.first(F.struct(*own.columns)).alias("row"),
                                                             F.count("*").alias("n")), "line-rows")
    keeps = counted.groupBy("doc", "mark").agg(F.min("key").alias("keeps"))
    each = (counted.join(keeps, ["doc", "mark"]).join(gone, ["doc", "mark"], "left")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))))
    whole = (F.col("key") == F.col("keeps")) & (F.col("copy") == 1)
    words = lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))
    kept = F.filter(F.split(F.col(f"row.{text}"), "\n"), lambda line, i: ~words(line) | (
        whole & ~F.coalesce(F.array_contains("gone", i), F.lit(False))))
    cut = F.when(F.col(f"row.{text}").isNotNull(), F.array_join(kept, "\n"))
    return own_names(each.select(*[cut.alias(c) if c == text else F.col(f"row.{c}").alias(c) for c in own.columns]), docs)
