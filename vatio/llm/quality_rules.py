"""Quality rules: fixed limits first, then robust multivariate outliers. For
each language and source a minimum-covariance-determinant estimate of location
and scatter is fitted to transformed document statistics, and documents far
from it by Mahalanobis distance are rejected.

The estimate is a deterministic MCD (no random subsets): three starts take
concentration steps, each over all documents (the distances' quantile, then sums
over the closest share, per group), the smallest determinant goes on until its
steps converge. Statistics are whole multiples of 1 / GRID, so sums and quantiles are
exact and reruns agree; each step is two groupings with map-side sums, so a
source with a third of all rows is no single task's work."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, written

# ---- Fixed values -----------------------------------------------------------
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# -----------------------------------------------------------------------------
STATISTICS = ("log_words", "word_length", "symbols", "repeats", "duplicate_lines", "capitals", "digits", "marks")
GRID = 1024
#: Least standard deviation of each statistic: rates that are zero in most documents
#: would else make any document that has one an outlier.
FLOORS = (0.25, 0.08, 0.03, 0.15, 0.2, 0.05, 0.08, 0.05)
#: Share of a group's documents that the estimate is concentrated on.
SHARE = 0.75
#: Concentration steps that every start takes before the best one goes on.
TRIAL_STEPS = 2
#: A step that lowers the logarithm of the determinant by no more than this is the last.
CONVERGED = 1e-6
#: Estimates of all groups are broadcast up to this size, by their counted rows.
BROADCAST_BYTES = 32 << 20
#: Groups with fewer documents are pooled: first by language, then all together.
MIN_GROUP = 100
#: Upper tail of the chi-square law whose quantile is the limit of the squared distance.
TAIL = 1e-6

_COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
    "n_digits", "n_marks")])


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first included."""
    n = len(words)
    if n < WINDOW + 1:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    pairs = a[:-1] * len(ids) + a[1:]
    if len(ids) < 1 << 20:
        keys = pairs[:-1] * len(ids) + a[2:]
    else:  # three factors would not fit in 64 bits
        keys = np.unique(pairs, return_inverse=True)[1].astype(np.int64)[:-1] * len(ids) + a[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    repeated = np.zeros(len(keys), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for i in range(WINDOW):
        covered[i:i + len(keys)] |= repeated
    return int(covered.sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    ascii_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    return (len(words), len(text) - sum(int(ascii_[ord(c)]) for c in SPACES),
            sum(int(ascii_[ord(c)]) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words),
            len(lines), int(ascii_[65:91].sum()), int(ascii_[48:58].sum()),
            sum(int(ascii_[ord(c)]) for c in "!?.,;:"))


def document_counts(text: Column) -> Column:
    """struct of the counts that the rules and statistics need."""
    @F.pandas_udf(_COUNTS)
    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([counts_of(t) for t in texts], columns=_COUNTS.fieldNames(), dtype="int64")
    return count(text)


def _vector() -> list[Column]:
    """The statistics, in whole multiples of 1 / GRID: logarithms of lengths and
    variance-stabilised rates."""
    def angle(part: str, whole: str) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / F.greatest(F.lit(1), F.col(whole)))))

    raw = [F.log1p("n_words"), F.log1p(F.col("word_chars") / F.greatest(F.lit(1), F.col("n_words"))),
           angle("n_symbols", "word_chars"), angle("n_repeat_words", "n_words"), angle("n_dup_lines", "n_lines"),
           angle("n_capitals", "word_chars"), angle("n_digits", "word_chars"), angle("n_marks", "word_chars")]
    return [F.floor(x * GRID + 0.5).cast("bigint").alias(f"x{i}") for i, x in enumerate(raw)]


def chi_square_tail(x: float, freedom: int) -> float:
    """Probability that a chi-square variable exceeds ``x``: one less the
    series of the lower incomplete gamma function."""
    if x <= 0:
        return 1.0
    a, h = freedom / 2, x / 2
    term = total = 1 / a
    k = 0
    while term > total * 1e-16:
        k += 1
        term *= h / (a + k)
        total += term
    return 1 - total * math.exp(a * math.log(h) - h - math.lgamma(a))


def chi_square_quantile(tail: float, freedom: int) -> float:
    """Point that a chi-square variable exceeds with probability ``tail``."""
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_tail(mid, freedom) > tail else (lo, mid)
    return hi


def _groups(rows: DataFrame, min_group: int) -> DataFrame:
    """(lang, source, grp): the group whose estimate judges a language and source."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    pooled = F.to_json(F.struct("lang"))
    named = sizes.select("lang", "source", "n", F.when(
        F.col("n") >= min_group, F.to_json(F.struct("lang", "source", F.lit(1).alias("own")))).otherwise(pooled).alias("g"))
    totals = named.groupBy("g").agg(F.sum("n").alias("total"))
    return named.join(totals, "g").select("lang", "source", F.when(
        F.col("total") >= min_group, F.col("g")).otherwise(F.lit("*")).alias("grp"))


def _distance(p: int) -> Column:
    """Squared Mahalanobis distance of the row from its group's estimate."""
    total = F.lit(0.0)
    d = [F.col(f"x{i}") / F.lit(float(GRID)) - F.col("mu")[i] for i in range(p)]
    for i in range(p):
        row = F.lit(0.0)
        for j in range(i, p):
            row = row + F.col("prec")[i * p + j] * d[j] * F.lit(1.0 if i == j else 2.0)
        total = total + row * d[i]
    return total


_STEP = "grp string, start int, mu array<double>, prec array<double>, logdet double"


def _sums(p: int) -> list[Column]:
    """Count, sums and sums of products. Whole numbers below 2^15 each, so longs hold a
    group of 10^10 documents."""
    xs = [F.col(f"x{i}") for i in range(p)]
    return [F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(xs)],
            *[F.sum(xs[i] * xs[j]).alias(f"q{i}_{j}") for i in range(p) for j in range(i, p)]]


def moments(r, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance from a group's exact sums."""
    n = float(r.n)
    mean = np.array([float(getattr(r, f"s{i}")) for i in range(p)]) / n / GRID
    second = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            second[i, j] = second[j, i] = float(getattr(r, f"q{i}_{j}")) / n / GRID / GRID
    return mean, second - np.outer(mean, mean)


def consistency(share: float, p: int) -> float:
    """The scatter of the closest share of a normal law is too small by this factor."""
    return share / (1 - chi_square_tail(chi_square_quantile(1 - share, p), p + 2))


def _estimate(sums: DataFrame, p: int, share: float) -> DataFrame:
    """Location, inverse scatter and its log determinant for each (grp, start), from exact
    sums: linear algebra on one row per group. ``share``: kept share, for consistency."""
    ship(sums)
    floors, factor = np.diag(np.square(np.array(FLOORS))), consistency(share, p)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                mean, scatter = moments(r, p)
                scatter = factor * scatter + floors
                out.append((r.grp, r.start, mean.tolist(), np.linalg.inv(scatter).ravel().tolist(),
                            float(np.linalg.slogdet(scatter)[1])))
            yield pd.DataFrame(out, columns=["grp", "start", "mu", "prec", "logdet"])

    return sums.mapInPandas(solve, _STEP)


def _starts(rows: DataFrame, p: int, hint) -> DataFrame:
    """Three deterministic starts for each group: medians with median absolute deviations;
    mean and covariance; medians with the correlations of the standardised statistics'
    hyperbolic tangents, which far values hardly move."""
    # The values are whole numbers of a bounded range, so exact percentiles keep bounded counts.
    mid = written(rows.groupBy("grp").agg(*[F.percentile(f"x{i}", F.lit(0.5)).alias(f"m{i}") for i in range(p)]), "medians")
    spread = written(rows.join(hint(mid), "grp").groupBy("grp").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(p)],
        *[F.percentile(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), F.lit(0.5)).alias(f"d{i}") for i in range(p)]), "spreads")
    scale = [F.sqrt(F.pow(F.col(f"d{i}") * F.lit(1.4826 / GRID), F.lit(2.0)) + F.lit(FLOORS[i] ** 2)) for i in range(p)]
    # Rounded like the statistics, so that sums are exact.
    bent = rows.join(hint(spread), "grp").select("grp", *[
        F.round(F.tanh((F.col(f"x{i}") - F.col(f"m{i}")) / F.lit(float(GRID)) / scale[i]) * GRID).cast("bigint").alias(f"x{i}")
        for i in range(p)])
    sums = rows.groupBy("grp").agg(*_sums(p)).withColumn("start", F.lit(1)).unionByName(
        bent.groupBy("grp").agg(*_sums(p)).withColumn("start", F.lit(2)))
    both = sums.join(hint(spread), "grp")
    ship(rows)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                mean, cov = moments(r, p)
                mid = np.array([getattr(r, f"m{i}") for i in range(p)], dtype=float) / GRID
                sd = np.sqrt(np.square(np.array([getattr(r, f"d{i}") for i in range(p)], dtype=float) * 1.4826 / GRID)
                             + np.square(FLOORS))
                for start, mu, scatter in starts_from(int(r.start), mean, cov, mid, sd):
                    out.append((r.grp, start, mu.tolist(), np.linalg.inv(scatter).ravel().tolist(),
                                float(np.linalg.slogdet(scatter)[1])))
            yield pd.DataFrame(out, columns=["grp", "start", "mu", "prec", "logdet"])

    return written(both.mapInPandas(solve, _STEP), "estimate")


def starts_from(kind: int, mean: np.ndarray, cov: np.ndarray, mid: np.ndarray, sd: np.ndarray) -> list:
    """(start, location, scatter) from the moments of the statistics (1, which gives the start
    of medians alone as well) or of their tangents (2)."""
    if kind == 1:
        return [(0, mid, np.diag(np.square(sd))), (1, mean, cov + np.diag(np.square(FLOORS)))]
    width = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = cov / np.outer(width, width)
    np.fill_diagonal(corr, 1.0)
    # A little of the identity: statistics that hardly vary leave the matrix near singular.
    return [(2, mid, np.outer(sd, sd) * (0.95 * corr + 0.05 * np.eye(len(sd))))]


def estimates(rows: DataFrame, share: float = SHARE) -> DataFrame:
    """(grp, mu, prec) from ``rows`` (grp, x0, x1, ...), one row per group: the minimum
    covariance determinant over deterministic starts.

    Every start takes TRIAL_STEPS concentration steps: the closest share of the group's
    documents by the estimate gives the next. The start of the smallest determinant then
    goes on until a step no longer lowers it; at last one reweighting step.
    """
    p = len(STATISTICS)
    xs = [f"x{i}" for i in range(p)]
    groups = rows.select("grp").distinct().count()
    # A row of a group's estimate: its inverse scatter, its location and its name.
    hint = F.broadcast if groups * 8 * (p * p + p + 16) * 3 <= BROADCAST_BYTES else (lambda df: df)

    def step(now: DataFrame) -> DataFrame:
        far = rows.join(hint(now), "grp").select("grp", "start", *xs, F.floor(F.log2(F.lit(1.0) + _distance(p)) * 64)
                                                 .cast("bigint").alias("far"))
        limits = written(far.groupBy("grp", "start").agg(F.percentile("far", F.lit(share)).alias("limit")), "limits")
        close = far.join(hint(limits), ["grp", "start"]).filter("far <= limit")
        return written(_estimate(close.groupBy("grp", "start").agg(*_sums(p)), p, share), "estimate")

    def least(*frames: DataFrame) -> DataFrame:
        """The estimate of the smallest determinant of each group; ties to the first start."""
        every = frames[0]
        for f in frames[1:]:
            every = every.unionByName(f)
        best = every.groupBy("grp").agg(F.min_by(F.struct("start", "mu", "prec", "logdet"), F.struct("logdet", "start")).alias("b"))
        return written(best.select("grp", "b.*"), "estimate")

    now = _starts(rows, p, hint)
    for _ in range(TRIAL_STEPS):
        now = step(now)
    best = least(now)
    going = best
    while not going.isEmpty():
        after = step(going)
        lower = (after.join(going.select("grp", F.col("logdet").alias("was")), "grp")
                 .filter(F.col("logdet") < F.col("was") - F.lit(CONVERGED)).drop("was"))
        going = written(lower, "estimate")
        best = least(best, going)
    # One step over all that are within the usual 97.5 % of the estimate.
    inner = rows.join(hint(best), "grp").filter(_distance(p) <= F.lit(chi_square_quantile(0.025, p)))
    again = _estimate(inner.groupBy("grp", "start").agg(*_sums(p)), p, 0.975).select("grp", "mu", "prec")
    both = best.select("grp", F.col("mu").alias("mu0"), F.col("prec").alias("prec0")).join(again, "grp", "left")
    return written(both.select("grp", F.coalesce("mu", "mu0").alias("mu"), F.coalesce("prec", "prec0").alias("prec")),
                   "estimate")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, ``base_failed``,
    ``distance`` (squared, null where the base rules fail) and ``kept``.

    Null text counts as empty and fails the base rules. Documents that fail
    them take no part in the estimates. Null languages and sources are values
    of their own. A group (all documents pooled, where languages are small too)
    of fewer documents than statistics keeps all that pass the base rules.
    Equal rows are judged alike; other columns are ignored.
    """
    ship(docs)
    p = len(STATISTICS)
    counted = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"),
                          F.col(source).cast("string").alias("source"),
                          document_counts(F.col(text)).alias("c")).select("doc_id", "lang", "source", "c.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = written(counted.select("*", failed.alias("base_failed"), *_vector()), "statistics")
    fit = rows.filter(~F.col("base_failed"))
    named = written(_groups(fit, min_group), "groups")
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]

    def with_group(r: DataFrame, how: str) -> DataFrame:
        g = named.withColumnRenamed("lang", "g_lang").withColumnRenamed("source", "g_source")
        return r.join(g, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), how)

    found = estimates(with_group(fit, "inner").select("grp", *[f"x{i}" for i in range(p)]))
    sizes = with_group(fit, "inner").groupBy("grp").agg(F.count("*").alias("members"))
    limit = chi_square_quantile(TAIL, p)
    judges = written(found.join(sizes, "grp"), "judges")
    small = judges.count() * 8 * (p * p + p + 16) <= BROADCAST_BYTES
    far = with_group(rows, "left").join(F.broadcast(judges) if small else judges, "grp", "left")
    distance = F.when(~F.col("base_failed"), _distance(p))
    kept = ~F.col("base_failed") & ((F.col("members") <= p) | F.coalesce(F.col("distance") <= limit, F.lit(True)))
    return far.withColumn("distance", distance).select(*base, "distance", kept.alias("kept"))
