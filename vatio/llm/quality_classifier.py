"""Quality classifier: random Fourier features approximate a Gaussian kernel
over document statistics, ridge regression is fitted through normal equations
summed over partitions, and isotonic regression turns its values into
probabilities. The model is some hundred kilobytes and travels in the scoring
function; a text is read once, where it lies."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, own_names, plain, plain_names, ship, written

STATISTICS = (
    "log_words", "word_length", "word_length_spread", "long_words", "distinct_words", "repeated_triples",
    "stutters", "symbols", "marks", "exclamations", "bars", "capitals", "digits", "lines", "line_words",
    "duplicate_lines", "entropy", "top_word")
#: Labelled documents in the fit (as expected; the count varies by its root): those whose id
#: hashes under a share of the range, and of those with many texts a like share of these.
#: The bound keeps the training table small at any size.
FIT_ROWS = 40_000
FEATURES = 400
RIDGE = 1e-2
#: Kernel width in standard deviations per statistic, times the root of their number.
WIDTH = 0.6
SEED = 20_240_607
#: Parts of the labelled rows; the calibration sees each through weights fitted without it.
CALIBRATION_FOLDS = 4
THRESHOLD = 0.3


def statistics_of(text: str | None) -> list[float]:
    """Statistics of a text; those of an empty text are all zero."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lens = np.fromiter(map(len, words), np.int64, n)
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    counts = np.bincount(a)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = int(lens.sum())
    if n > 2:
        triples = (a[:-2] * 1_000_003 + a[1:-1]) * 1_000_003 + a[2:]
        repeated = 1 - len(np.unique(triples)) / len(triples)
    else:
        repeated = 0.0
    lines = [x for x in text.split("\n") if x.strip()]
    share = bytes_[bytes_ > 0] / len(raw)
    rate = lambda chars_: sum(int(bytes_[ord(c)]) for c in chars_) / chars
    return [
        np.log1p(n), lens.mean(), lens.std(), float((lens > 12).mean()), len(ids) / n, repeated,
        float((a[1:] == a[:-1]).mean()) if n > 1 else 0.0,
        np.sqrt(rate("#*$%&<>@^~")), np.sqrt(rate(".,;:?'\"()-")), np.sqrt(rate("!")), np.sqrt(rate("|")),
        int(bytes_[65:91].sum()) / chars, np.sqrt(int(bytes_[48:58].sum()) / chars), np.log1p(len(lines)),
        np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
        float(-(share * np.log2(share)).sum()), np.sqrt(counts.max() / n)]


def statistics(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def make(texts: pd.Series) -> pd.Series:
        return pd.Series([[float(x) for x in statistics_of(t)] for t in texts], dtype="object")
    return make(text)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray        # ridge values, ascending
    levels: np.ndarray       # calibrated scores at the knots, not falling

    def values(self, stats: np.ndarray) -> np.ndarray:
        return features(stats, self.mean, self.scale, self.directions, self.phases) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores; a hundredth of the score orders the values that share a level."""
        v = self.values(stats)
        width = self.knots[-1] - self.knots[0]
        inside = np.clip((v - self.knots[0]) / width, 0.0, 1.0) if width > 0 else 0.5
        return np.clip(0.99 * np.interp(v, self.knots, self.levels) + 0.01 * inside, 0.0, 1.0)


def features(stats, mean, scale, directions, phases) -> np.ndarray:
    """Cosines whose inner products approximate the Gaussian kernel, and a constant."""
    z = np.clip((stats - mean) / scale, -8, 8)
    cosines = np.cos(z @ directions + phases) * np.sqrt(2 / len(phases))
    return np.hstack([cosines, np.ones((len(stats), 1))])


def isotonic(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-falling step function closest to the
    labels, as knots at both ends of every pool. Equal values are pooled first."""
    knots, first = np.unique(values, return_inverse=True)
    weight = np.bincount(first).astype(float)
    level = np.bincount(first, weights=labels) / weight
    pools: list[list[float]] = []  # level, weight, first value, last value
    for v, y, w in zip(knots, level, weight):
        pools.append([y, w, v, v])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            y1, w1, _, hi = pools.pop()
            y0, w0, lo, _ = pools.pop()
            pools.append([(y0 * w0 + y1 * w1) / (w0 + w1), w0 + w1, lo, hi])
    xs = np.array([x for p in pools for x in (p[2], p[3])])
    ys = np.array([p[0] for p in pools for _ in (0, 1)])
    return xs, ys


def _level(sizes: list[tuple[int, int]], rows: int) -> int | None:
    """The most texts an id may give (at least one) so that all give up to ``rows``;
    None if they do as they are. ``sizes``: (texts, ids that have so many)."""
    if sum(n * ids for n, ids in sizes) <= rows:
        return None
    low, high = 1, max(n for n, _ in sizes)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(min(n, middle) * ids for n, ids in sizes) <= rows else (low, middle - 1)
    return low


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS,
                  doc_id: str = "doc_id", text: str = "text",
                  made: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """(doc_id, key, label, bytes, made) of about ``rows`` texts of labelled documents
    that are not held out, chosen by a hash of their id; all where there are no
    more. Null labels and ids are left out; an id labelled twice alike counts
    once, and so does a text that an id has several times. Where ids with many
    texts go beyond ``rows``, these give a like number each, chosen by hash.
    ``made`` is worked out from the text, ``key`` and ``bytes`` are its hash and
    length."""
    marks = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("double").alias("label")) \
        .filter("__id is not null and label is not null").filter(~held_out(F.col("__id")))
    marks = written(marks.distinct(), "labels")
    part = min(1.0, rows / max(1, marks.count()))
    chosen = marks.filter(F.pmod(F.xxhash64("__id", F.lit(SEED)), F.lit(1 << 20)) < int(part * (1 << 20)))
    # Bounded by ``rows``, so it is sent to the texts and no text is shuffled.
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select(
        "doc_id", "text", "label", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    distinct = written(found.select("doc_id", "label", "key").distinct(), "label-texts")
    sizes = distinct.groupBy("doc_id").agg(F.count("*").alias("n"))
    level = _level([tuple(r) for r in sizes.groupBy("n").count().collect()], rows)
    if level is not None:
        # One row per chosen id with more texts: bounded as ``chosen``.
        many = sizes.filter(F.col("n") > level).withColumnRenamed("doc_id", "__id")
        share = F.pmod(F.xxhash64("doc_id", "key", F.lit(SEED)), F.lit(1 << 40)) < F.lit(level * 2.0 ** 40) / F.col("n")
        found = found.join(F.broadcast(many), F.col("doc_id") == F.col("__id"), "left").filter(
            F.col("n").isNull() | share)
    return found.select("doc_id", "key", "label", F.octet_length(F.coalesce("text", F.lit(""))).alias("bytes"),
                        made(F.col("text")).alias("made")) \
        .groupBy("doc_id", "key", "label").agg(F.first("bytes").alias("bytes"), F.first("made").alias("made"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS,
        n_features: int = FEATURES, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on about ``rows`` texts of labelled documents outside the held-out fold.

    Ridge weights are fitted to all of them; the calibration is fitted to values
    that each part of them (by hash of the id) gets from weights fitted without
    it. Without any labelled row the model scores 0.5 throughout.
    """
    ship(docs)
    train = written(training_rows(docs, labels, label, rows, doc_id, text, statistics).select(
        F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(CALIBRATION_FOLDS)).cast("int").alias("fold"),
        F.col("made").alias("stats"), "label", "doc_id", "key").repartition(CALIBRATION_FOLDS, "fold")
        .sortWithinPartitions("doc_id", "key", "label").drop("doc_id", "key"), "fit-statistics")
    p, size = len(STATISTICS), n_features + 1
    moments = train.agg(F.array(*[F.avg(F.col("stats")[i]) for i in range(p)]),
                        F.array(*[F.stddev_pop(F.col("stats")[i]) for i in range(p)])).first()
    rng = np.random.default_rng(SEED)
    directions = rng.standard_normal((p, n_features)) / (WIDTH * np.sqrt(p))
    phases = rng.uniform(0, 2 * np.pi, n_features)
    if moments[0][0] is None:
        zero, one = np.zeros(p), np.ones(p)
        return Model(zero, one, directions, phases, np.zeros(size), np.array([0.0]), np.array([0.5]))
    mean = np.array(moments[0])
    scale = np.maximum(np.array(moments[1]), 1e-3)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for fold, g in b.groupby("fold"):
                z = features(np.array(g["stats"].tolist()), mean, scale, directions, phases)
                total = grams.setdefault(int(fold), [np.zeros((size, size)), np.zeros(size)])
                total[0] += z.T @ z
                total[1] += z.T @ g["label"].to_numpy()
        yield pd.DataFrame([(k, g.tobytes(), r.tobytes()) for k, (g, r) in grams.items()],
                           columns=["fold", "gram", "rhs"])

    parts: dict[int, list[np.ndarray]] = {}
    for fold, g, r in train.mapInPandas(sums, "fold int, gram binary, rhs binary").collect():
        have = parts.setdefault(fold, [np.zeros((size, size)), np.zeros(size)])
        have[0] += np.frombuffer(g).reshape(size, size)
        have[1] += np.frombuffer(r)
    gram, right = sum(g for g, _ in parts.values()), sum(r for _, r in parts.values())

    def solve(g: np.ndarray, r: np.ndarray) -> np.ndarray:
        return np.linalg.solve(g + RIDGE * max(1.0, g[-1, -1] ** 0.5) * 0.1 * np.eye(size), r)

    model = Model(mean, scale, directions, phases, solve(gram, right), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    # About FIT_ROWS statistics vectors: the calibration's table.
    seen = train.select("fold", "stats", "label").toPandas()
    values = np.empty(len(seen))
    for fold, (g, r) in parts.items():
        mine = (seen["fold"] == fold).to_numpy()
        weights = solve(gram - g, right - r) if len(parts) > 1 else model.weights
        values[mine] = features(np.array(seen["stats"][mine].tolist()), mean, scale, directions, phases) @ weights
    model.knots, model.levels = isotonic(values, seen["label"].to_numpy())
    return model


def quality_score(text: Column, model: Model) -> Column:
    """Score of a text, 0 to 1; null counts as empty."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.scores(np.array([statistics_of(t) for t in texts], dtype=float)))
    return score(text)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on).

    Only the text enters a score. Null and empty texts get the score of an
    empty text; equal texts get equal scores; empty tables and columns with the
    output names (replaced) are fine.
    """
    ship(docs)
    model = fit(docs, labels, label, doc_id=doc_id, text=text)
    return docs.withColumn("score", quality_score(F.col(text), model)) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    ship(docs)
    model = fit(docs, labels)
    own = plain_names(docs)
    scored = own.withColumn("__score", quality_score(F.col(plain(docs, "text")), model))
    return own_names(scored.filter(F.col("__score") >= threshold), docs)
