"""Spelling variants: words one edit apart, each with the far more frequent
form it is a variant of (operator 13).

Method: a relational trie. A node is the text of a prefix; the node table holds
one row per prefix with the set of its next letters and a mark for a whole word.
States are rows (word, position, node, edits) that join the node table one trie
depth after the other; a state with one edit that ends at a whole word makes
the two words neighbours.

The words stand in two tries, forwards and backwards, and are edited only in
their later half there (the first half of a word is the later half of its
reverse), so no state branches near a root. Two edits are enough, as neighbours
are symmetric: a letter replaced by a greater one, and a letter left out (the
last of a run of equal letters). States without an edit lie on the word's own
path and are joined for all depths at once; from there on the frontier moves
depth by depth until it is empty.

Words over ``LONG`` letters would need a step per letter; they are compared
exactly by halves instead: of two words one edit apart, the first or the last
half of the shorter is also the first or the last of the other.

Odd input: a null text has no words, a null id counts as the empty text before
the colon; repeated rows count as often as they stand there; an empty table
gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ship, written

#: Words have at least so many code points and so many occurrences.
MIN_LETTERS, MIN_COUNT = 7, 2
#: A form is at least so many times as frequent as its variant.
FORM_RATIO = 10
#: One run in DAMAGE, told by its hash, loses a letter (fixed by the contract of the query).
DAMAGE = 31
#: Words of up to so many letters go through the tries.
LONG = 24
#: Distinct words that a task counts before it hands them on.
HELD = 200_000

RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)
#: Node masks: a-z are bits 0 to 25 of ``lo``, U+00C0-U+00FF bits 0 to 63 of ``hi``.
END = 1 << 40


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (word, n) of a task; the dictionary is handed on when full."""
    held: dict[str, int] = {}

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                       names=["word", "n"])
        held.clear()
        return b

    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1)):
            data = text.as_py()
            if not data:
                continue
            prefix = zlib.crc32((key.as_py() or b"") + b":")
            damaged: dict[str, str] = {}
            for run in RUN.findall(data.lower().decode("utf-8", "replace")):
                word = damaged.get(run)
                if word is None:
                    h = zlib.crc32(run.encode(), prefix)
                    at = h % len(run)
                    word = damaged[run] = run[:at] + run[at + 1:] if h % DAMAGE == 0 else run
                if len(word) >= MIN_LETTERS:
                    held[word] = held.get(word, 0) + 1
            if len(held) >= HELD:
                yield out()
    if held:
        yield out()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts, lower-cased A-Z only, damaged by the
    contract's rule, with at least ``MIN_LETTERS`` letters and ``MIN_COUNT`` occurrences."""
    ship(docs)
    given = docs.select(F.col(id_col).cast("string").cast("binary").alias("k"),
                        F.col(text_col).cast("string").cast("binary").alias("t"))
    return (given.mapInArrow(_counts, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT))


def _mask(letter: str) -> tuple[Column, Column]:
    """(lo, hi) with the bit of one letter set; no letter marks the end of a word."""
    none = "CAST(0 AS BIGINT)"
    lo = F.expr(f"CASE WHEN {letter} = '' THEN {END}L WHEN ascii({letter}) < 128 "
                f"THEN shiftleft(1L, ascii({letter}) - 97) ELSE {none} END")
    hi = F.expr(f"CASE WHEN ascii({letter}) < 128 THEN {none} ELSE shiftleft(1L, ascii({letter}) - 192) END")
    return lo, hi


def _has(letter: str) -> str:
    """SQL: whether the node's mask (lo, hi) has this letter."""
    return (f"(CASE WHEN ascii({letter}) < 128 THEN getbit(lo, ascii({letter}) - 97) = 1 "
            f"ELSE getbit(hi, ascii({letter}) - 192) = 1 END)")


def _children() -> str:
    """SQL: the node's next letters as an array, in code-point order."""
    low = "filter(sequence(0, 25), i -> getbit(lo, i) = 1)"
    high = "filter(sequence(0, 63), i -> getbit(hi, i) = 1)"
    return (f"concat(transform({low}, i -> chr(97 + i)), "
            f"CASE WHEN hi = 0 THEN array() ELSE transform({high}, i -> chr(192 + i)) END)")


def _by_depth(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in one folder for each depth, so that a level reads its own rows."""
    spark = df.sparkSession
    path, files = scratch_path(spark, name), max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    (df.repartition("depth", F.pmod(F.xxhash64("node"), F.lit(files)))
     .write.partitionBy("depth").parquet(path))
    return spark.read.schema(df.schema).parquet(path)


def _trie_pairs(words: DataFrame) -> DataFrame:
    """(a, b): pairs of words of up to ``LONG`` letters one edit apart, each found at least once."""
    both = (words.select(F.col("word").alias("w"), F.lit(">").alias("way"), F.expr("length(word) div 2").alias("h"))
            .unionByName(words.select(F.reverse("word").alias("w"), F.lit("<").alias("way"),
                                      F.expr("length(word) - length(word) div 2").alias("h"))))
    path = both.select("w", "way", "h", F.explode(F.expr("sequence(3, length(w))")).alias("depth"))
    path = path.select("way", "w", "h", "depth", F.expr("left(w, depth)").alias("node"),
                       F.expr("substring(w, depth + 1, 1)").alias("c"))
    lo, hi = _mask("c")
    nodes = _by_depth(path.select("way", "depth", "node", lo.alias("lo"), hi.alias("hi"))
                      .groupBy("way", "depth", "node").agg(F.bit_or("lo").alias("lo"), F.bit_or("hi").alias("hi")),
                      "trie-nodes")
    # States without an edit: on the word's own path, at nodes where it can be left.
    rich = nodes.filter("bit_count(lo) + bit_count(hi) >= 2")
    own = path.filter("depth >= h AND c <> ''").join(rich, ["way", "depth", "node"])
    own = own.withColumn("nx", F.expr("substring(w, depth + 2, 1)"))
    swapped = F.expr(f"transform(filter({_children()}, x -> x > c), "
                     "x -> named_struct('pos', depth + 1, 'node', concat(node, x), 'done', false))")
    left_out = F.expr(
        "CASE WHEN nx = c THEN array() "
        f"WHEN nx = '' THEN CASE WHEN lo & {END} <> 0 THEN array(named_struct('pos', depth + 1, 'node', node, 'done', true)) ELSE array() END "
        f"WHEN {_has('nx')} THEN array(named_struct('pos', depth + 2, 'node', concat(node, nx), 'done', false)) ELSE array() END")
    edited = own.select("way", "w", "depth", F.explode(F.concat(swapped, left_out)).alias("s"))
    edited = _by_depth(edited.select("way", "w", F.col("s.pos").alias("pos"), F.col("s.node").alias("node"),
                                     F.col("s.done").alias("done"), F.length("s.node").alias("depth")), "trie-edited")
    found = edited.filter("done").select("way", F.col("w").alias("a"), F.col("node").alias("b"))
    seeds = edited.filter("NOT done").select("way", "w", "pos", "node", "depth")
    # The frontier: one join with the nodes of a depth, until the last word ends.
    last = (seeds.agg(F.min("depth"), F.max("depth"))).first()
    frontier = None
    depth = last[0]
    while depth is not None and depth <= LONG:
        here = seeds.filter(F.col("depth") == depth).drop("depth")
        if frontier is not None:
            here = here.unionByName(frontier)
        met = here.join(nodes.filter(F.col("depth") == depth).drop("depth"), ["way", "node"])
        met = met.withColumn("c", F.expr("substring(w, pos + 1, 1)"))
        step = written(met.filter(F.expr(f"CASE WHEN c = '' THEN lo & {END} <> 0 ELSE {_has('c')} END"))
                       .select("way", "w", (F.col("pos") + 1).alias("pos"), F.expr("concat(node, c)").alias("node"),
                               (F.col("c") == "").alias("done")), "trie-frontier")
        found = found.unionByName(step.filter("done").select("way", F.col("w").alias("a"), F.col("node").alias("b")))
        frontier = step.filter("NOT done").drop("done")
        depth += 1
        if depth > last[1] and frontier.isEmpty():
            break
    forwards = F.col("way") == ">"
    return found.select(F.when(forwards, F.col("a")).otherwise(F.reverse("a")).alias("a"),
                        F.when(forwards, F.col("b")).otherwise(F.reverse("b")).alias("b"))


def _long_pairs(words: DataFrame) -> DataFrame:
    """(a, b): pairs one edit apart of which one word is over ``LONG`` letters, a the shorter
    (or, of one length, the lesser). They share the first ``k // 2`` or the last
    ``k - k // 2`` letters, k being the length of the shorter."""
    of = words.filter(F.length("word") >= LONG).select("word", F.length("word").alias("len"))

    def keys(k: str) -> Column:
        return F.expr(f"array(concat('<', left(word, {k} div 2)), concat('>', right(word, {k} - {k} div 2)))")

    short = of.select(F.col("word").alias("a"), F.col("len").alias("k"), F.explode(keys("len")).alias("key"))
    other = (short.select(F.col("a").alias("b"), "k", "key")
             .unionByName(of.select(F.col("word").alias("b"), (F.col("len") - 1).alias("k"),
                                    F.explode(keys("(len - 1)")).alias("key"))))
    near = short.join(other, ["k", "key"]).filter(
        f"a <> b AND length(b) > {LONG} AND (length(a) < length(b) OR a < b)")
    return near.filter(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near), in both directions and each once, for ``words`` (word: distinct
    texts of a-z and U+00C0-U+00FF with at least ``MIN_LETTERS`` letters)."""
    pairs = _trie_pairs(words.filter(F.length("word") <= LONG)).unionByName(_long_pairs(words))
    return (pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .select(F.col("a").alias("word"), F.col("b").alias("near")).distinct())


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last. Each round doubles
    the steps; a step multiplies the occurrences by ``FORM_RATIO``, so chains end."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(now.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots")
        now = step.drop("moved")
        if step.filter("moved").isEmpty():
            return now


def group_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for ``words`` (word, n): see the contract of op13."""
    words = written(words.select("word", "n"), "spelling-words")
    pairs = neighbours(words.select("word"))
    best = (pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("near_n")).alias("neg"), "near")).alias("top")))
    best = written(best, "spelling-near")
    is_form = -F.col("top.neg") >= FORM_RATIO * F.col("n")
    rows = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("top.near")).alias("form"), F.when(is_form, -F.col("top.neg")).alias("form_n"))
    rows = written(rows, "spelling-forms")
    roots = _roots(rows.filter("form IS NOT NULL").select("word", "form"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
