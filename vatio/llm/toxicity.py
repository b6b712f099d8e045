"""Toxicity: a linear-chain conditional random field over the words of a line
tags toxic spans, forward-backward marginals per word give offending offsets,
and their totals give a document's score.

Only documents are labelled, so the words of the fit are labelled from them: a
word of a toxic document is toxic if one of its forms (the word, its first
letters) occurs in many toxic documents and hardly in others. The field learns
weights of those forms and of the steps between tags; a logistic function of
the marginals' sum and maximum learns the documents' labels. The model is a few
megabytes at most and travels in the scoring function."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from .quality_classifier import training_rows

#: Labelled documents in the fit (as expected), half of them toxic where there are as many.
FIT_ROWS = 2_400
#: Bytes of their texts at most, half for each label: the fit runs on the driver.
FIT_BYTES = 64 << 20
#: A form marks toxic words if it is in so many toxic documents, in such a share of them, and
#: in others at most MAX_CLEAN_SHARE as often.
MIN_TOXIC, MIN_TOXIC_SHARE, MAX_CLEAN_SHARE = 4, 0.015, 0.05
PREFIXES = (3, 4, 5, 6)
EPOCHS, RATE, DECAY, BATCH = 8, 0.3, 1e-4, 256
#: Words in one chain of the fit at most: longer lines are cut into such pieces.
PIECE = 100
THRESHOLD = 0.5
#: Lines scored together: bounds the memory of a step, not what is read.
LINES = 4_096
#: Words whose weights a worker remembers at most.
REMEMBERED = 400_000
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‘’…–—¡¿"
SEED = 20_240_608


def forms(word: str) -> list[str]:
    """The features of a word: itself (after "=") and its first letters,
    lower-cased and without marks at its ends. They depend on the word only, so
    a worker computes them once per word."""
    w = word.strip(EDGES).lower()
    return ["=" + w, *[w[:k] for k in PREFIXES if len(w) > k]] if w else []


@dataclass
class Model:
    weights: dict[str, float]   # per form, for the tag "toxic" against "clean"
    bias: float
    start: float                # log odds of a toxic first word
    steps: np.ndarray           # 2 x 2 log weights of tag to tag
    document: np.ndarray        # logistic weights: constant, log sum, largest log odds


def chain(emissions: np.ndarray, lengths: np.ndarray, start: float, steps: np.ndarray):
    """Marginal log odds of "toxic" per word of a batch of lines (lines x words,
    padded), by forward and backward odds; also the odds themselves.

    With two tags a message is one number, the odds of its two entries, so a
    step is a few operations on a column of the batch.
    """
    n, width = emissions.shape
    t = np.exp(steps)
    forward, backward = np.empty((width, n)), np.zeros((width, n))
    e = emissions.T
    forward[0] = e[0] + start
    for k in range(1, width):
        odds = np.exp(forward[k - 1])
        forward[k] = e[k] + np.log((t[0, 1] + odds * t[1, 1]) / (t[0, 0] + odds * t[1, 0]))
    for k in range(width - 2, -1, -1):
        odds = np.exp(e[k + 1] + backward[k + 1])
        message = np.log((t[1, 0] + odds * t[1, 1]) / (t[0, 0] + odds * t[0, 1]))
        backward[k] = np.where(k + 1 < lengths, message, 0.0)
    return (forward + backward).T, forward.T, backward.T


def _cells(lengths: np.ndarray) -> np.ndarray:
    """True where a padded batch of lines holds a word."""
    return np.arange(max(1, int(lengths.max(initial=1)))) < lengths[:, None]


def toxic_forms(texts: list[str], labels: list[int]) -> set[str]:
    """Forms that mark toxic words, by the shares of the toxic and the other
    documents that have them."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    total = [0, 0]
    for text, label in zip(texts, labels):
        found: set[str] = set()
        for w in set(text.split()):
            found.update(forms(w))
        seen[label].update(found)
        total[label] += 1
    share = max(1, total[1]) / max(1, total[0])
    least = max(MIN_TOXIC, MIN_TOXIC_SHARE * total[1])
    return {f for f, n in seen[1].items() if n >= least and seen[0][f] * share <= MAX_CLEAN_SHARE * n}


def fit_chain(lines: list[tuple[list[str], np.ndarray]]) -> Model:
    """Maximum likelihood of the tags of labelled lines by AdaGrad: gradients are
    observed less expected counts, the expected ones from the marginals. Forms
    of fewer than MIN_TOXIC lines get no weight."""
    lines = sorted(lines, key=lambda x: len(x[0]))
    seen = Counter(f for words, _ in lines for f in {f for w in set(words) for f in forms(w)})
    places = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= MIN_TOXIC))}
    index: dict[str, list[int]] = {}
    batches = []
    for a in range(0, len(lines), BATCH):  # lines of about one length
        batch = lines[a:a + BATCH]
        inside = _cells(np.array([len(words) for words, _ in batch]))
        tags = np.zeros(inside.shape)
        tags[inside] = np.concatenate([t for _, t in batch])
        flat: list[int] = []
        cell: list[int] = []
        for i, (words, _) in enumerate(batch):
            for j, w in enumerate(words):
                if w not in index:
                    index[w] = [places[f] for f in forms(w) if f in places]
                flat += index[w]
                cell += [i * inside.shape[1] + j] * len(index[w])
        batches.append((inside, tags, np.array(flat, np.int64), np.array(cell, np.int64)))
    weights = np.zeros(len(places))
    bias, start, steps = -3.0, 0.0, np.array([[1.0, -1.0], [0.0, 0.0]])
    sums = {"w": np.full(len(places), 1e-6), "b": 1e-6, "s": 1e-6, "t": np.full((2, 2), 1e-6)}
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            inside, tags, flat, cell = batches[k]
            e = np.bincount(cell, weights[flat], inside.size).reshape(inside.shape) + bias
            odds, forward, backward = chain(e, inside.sum(1), start, steps)
            gap = np.where(inside, tags - 1 / (1 + np.exp(-np.clip(odds, -50, 50))), 0.0)
            total = max(1.0, inside.sum() ** 0.5)
            g = np.bincount(flat, gap.ravel()[cell], len(places)) / total - DECAY * weights
            sums["w"] += g * g
            weights += RATE * g / np.sqrt(sums["w"])
            db = gap.sum() / total
            sums["b"] += db * db
            bias += RATE * db / np.sqrt(sums["b"])
            ds = gap[:, 0].sum() / total
            sums["s"] += ds * ds
            start += RATE * ds / np.sqrt(sums["s"])
            # Expected steps between neighbouring words from the pairwise marginals.
            pair = inside[:, 1:]
            f, b = forward[:, :-1][pair], (e + backward)[:, 1:][pair]
            left, right = tags[:, :-1][pair], tags[:, 1:][pair]
            joint = np.exp(np.clip([np.full_like(f, steps[0, 0]), b + steps[0, 1],
                                    f + steps[1, 0], f + b + steps[1, 1]], -50, 50))
            joint /= joint.sum(0)
            gained = np.array([((left == i) & (right == j)).sum() for i in (0, 1) for j in (0, 1)]) - joint.sum(1)
            dt = gained.reshape(2, 2) / total
            sums["t"] += dt * dt
            steps = steps + RATE * dt / np.sqrt(sums["t"])
    return Model({f: float(weights[i]) for f, i in places.items() if abs(weights[i]) > 1e-2},
                 float(bias), float(start), steps, np.zeros(3))


class Scorer:
    """Scores texts in a worker: whole lines are chains, batched by length."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
            return self._learn_all(words)
        self._learn_all(words - self.known.keys())

    def _learn_all(self, words: set[str]) -> None:
        weight, bias = self.model.weights.get, self.model.bias
        for w in words:
            self.known[w] = bias + sum([weight(f, 0.0) for f in forms(w)])

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """Log odds per word of each text, its lines' words in order."""
        words: list[str] = []
        lengths: list[int] = []
        sizes = []
        for text in texts:
            before = len(words)
            for line in text.split("\n"):
                w = line.split()
                if w:
                    words += w
                    lengths.append(len(w))
            sizes.append(len(words) - before)
        self._learn(set(words))
        emitted = np.fromiter(map(self.known.__getitem__, words), float, len(words))
        out = np.empty(len(words))
        n = np.array(lengths, np.int64)
        starts = np.cumsum(n) - n
        order = np.argsort(n, kind="stable")
        a = 0
        while a < len(order):
            # Lines of a batch are at most twice as long as its first: little is padding.
            b = min(a + LINES, int(np.searchsorted(n[order], 2 * n[order[a]], side="right")))
            some = order[a:b]
            inside = _cells(n[some])
            at = (starts[some][:, None] + np.arange(inside.shape[1]))[inside]
            e = np.zeros(inside.shape)
            e[inside] = emitted[at]
            out[at] = chain(e, n[some], self.model.start, self.model.steps)[0][inside]
            a = b
        return np.split(out, np.cumsum(sizes)[:-1]) if sizes else []

    def aggregate(self, odds: np.ndarray) -> list[float]:
        """What the document's score is a function of: constant, logarithm of
        one plus the expected number of toxic words, and the largest log odds."""
        if not len(odds):
            return [1.0, 0.0, -10.0]
        likely = odds[odds > -3]
        p = 1 / (1 + np.exp(-np.clip(likely, -50, 50)))
        return [1.0, float(np.log1p(p.sum())), float(np.clip(odds.max(), -10, 10))]

    def score(self, odds: np.ndarray) -> float:
        z = float(np.dot(self.model.document, self.aggregate(odds)))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def spans_of(text: str, odds: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of runs of words of one line that are likelier toxic than not."""
    spans, at, k, line_start = [], 0, 0, 0
    for line in text.split("\n"):
        at, last = 0, None
        for w in line.split():
            at = line.index(w, at)
            if odds[k] > 0:
                if last is None:
                    spans.append([line_start + at, 0])
                spans[-1][1] = line_start + at + len(w)
                last = k
            else:
                last = None
            at += len(w)
            k += 1
        line_start += len(line) + 1
    return [(a, b) for a, b in spans]


def beyond_bytes(texts: list[tuple[int, int, int]], limit: int) -> list[tuple[int, int]]:
    """(doc_id, key) of the texts (doc_id, key, bytes) that do not fit into ``limit``
    bytes, taken in the order of a hash."""
    out, total = [], 0
    for doc, key, size in sorted(texts, key=lambda t: (crc32(f"{t[0]}:{t[1]}".encode()), t)):
        if total + size > limit:
            out.append((doc, key))
        else:
            total += size
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS,
        doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on about ``rows`` texts (FIT_BYTES at most) of labelled documents outside the held-out fold, toxic
    and other ones alike in number where there are enough. Without toxic rows
    every score is that of a clean text."""
    ship(docs)
    parts = []
    for value in (0, 1):
        mine = labels.filter(F.col(label) == value)
        some = written(training_rows(docs, mine, label, rows // 2, doc_id, text), "fit-texts")
        # About rows // 2 hashes and lengths; the texts that come to the driver are bounded by their bytes too.
        order = some.select("doc_id", "key", "bytes").collect()
        if out := beyond_bytes([tuple(r) for r in order], FIT_BYTES // 2):
            beyond = docs.sparkSession.createDataFrame(out, some.select("doc_id", "key").schema)
            some = some.join(F.broadcast(beyond), ["doc_id", "key"], "left_anti")
        parts += some.select("doc_id", F.col("made").alias("text"), "label").collect()
    parts.sort(key=lambda r: (r["doc_id"], r["label"], r["text"] or ""))
    texts = [r["text"] or "" for r in parts]
    marks = [int(r["label"]) for r in parts]
    marking = toxic_forms(texts, marks)
    known: dict[str, bool] = {}
    lines = []
    for t, y in zip(texts, marks):
        for line in t.split("\n"):
            words = line.split()
            if not words:
                continue
            tags = np.zeros(len(words), np.int8)
            if y:
                for i, w in enumerate(words):
                    if w not in known:
                        known[w] = any(f in marking for f in forms(w))
                    tags[i] = known[w]
            lines += [(words[a:a + PIECE], tags[a:a + PIECE]) for a in range(0, len(words), PIECE)]
    if not any(marks) or not lines:
        return Model({}, -10.0, 0.0, np.zeros((2, 2)), np.array([-5.0, 0.0, 0.0]))
    with_tags = [x for x in lines if x[1].any()]
    without = [x for x in lines if not x[1].any()]
    rng = np.random.default_rng(SEED)
    # Of the lines without a toxic word, two for each with one.
    chosen = rng.permutation(len(without))[:2 * len(with_tags) + 1000]
    model = fit_chain(with_tags + [without[i] for i in chosen])
    scorer = Scorer(model)
    x = np.array([scorer.aggregate(o) for o in scorer.marginals(texts)])
    y = np.array(marks, float)
    # Scores rise with the largest odds and the sum. Logistic regression by Newton steps with a small ridge, both labels weighing alike.
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    z = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ z, -40, 40)))
        gradient = x.T @ (weight * (y - p)) - 0.1 * z
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        z = z + np.linalg.solve(curve, gradient)
    model.document = z
    return model


def toxicity(text: Column, model: Model) -> Column:
    """struct<score: double, spans: array<struct<start, end>>> of a text; offsets
    in code points, end exclusive. Null counts as empty."""
    @F.pandas_udf("struct<score:double,spans:array<struct<start:int,end:int>>>")
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for texts in batches:
            scores, spans = [], []
            todo = [t or "" for t in texts]
            for a in range(0, len(todo), 500):
                for t, odds in zip(todo[a:a + 500], scorer.marginals(todo[a:a + 500])):
                    scores.append(scorer.score(odds))
                    hit = spans_of(t, odds) if len(odds) and odds.max() > 0 else []
                    spans.append([{"start": s, "end": e} for s, e in hit])
            yield pd.DataFrame({"score": np.array(scores, dtype=float), "spans": pd.Series(spans, dtype="object")})
    return tag(text)


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id",
                    text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with ``out``: score and offending spans of the whole text.

    Only the text enters a score. Null, empty and wordless texts have the score
    of a text without toxic words and no spans; equal texts score alike; a
    column named ``out`` is replaced. A projection besides the fit.
    """
    ship(docs)
    return docs.withColumn(out, toxicity(F.col(text), fit(docs, labels, label, doc_id=doc_id, text=text)))
