"""Near duplicates among embeddings: cover trees and their dual traversal (operator 12).

Unit vectors are linked where their cosine reaches a threshold, that is where
their distance is at most ``tau = sqrt(2 - 2 * threshold)``; only vectors of one
label and one length are compared. Equal vectors are one point with a weight.

* The top of the tree is laid over the cluster. A label with more than ``BLOCK``
  points gets a net of pivots: a nested net with halving radii over a bounded
  sample, at most one pivot for ``BLOCK`` points and at most ``PIVOTS``. Every
  point belongs to the nearest pivot's cell, and each cell has a covering radius.
* A point is sent to another cell only if that cell's covering ball, widened by
  tau, holds it. Cells within tau / 2 of their pivot are cliques by the triangle
  inequality: their links are counted by place. Other cells are dealt into blocks
  of about ``BLOCK`` points and pairs of blocks are the tasks' groups, so that a
  label or cell with a third of all rows is many bounded groups.
* In a task each block becomes a cover tree (nets with halving radii, each node
  with the exact radius of its points). The dual traversal drops pairs of nodes
  farther apart than tau plus both radii, counts pairs of nodes whose points all
  lie within tau, and opens the rest down to pairs of points, whose cosine decides.

What leaves a task is a row per point: its number of links there and the
smallest point it is linked with there. Pairs never leave it.

The covering radii prune as far as the data have structure. Points spread alike
in all directions (random vectors in 64 dimensions lie about 1.4 apart, all of
them) cannot be told apart by any cell: then all pairs of blocks of a label meet.

Odd input: vectors that are null, empty, zero or hold null or non-finite
components, and vectors with a null label, link with nothing (component: their
own id). A null id is never a component's id if the component has another.
Repeated rows are vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, ship, written

THRESHOLD = 0.98
#: Points in a block; a task holds two blocks. Pivots of a label, at most.
BLOCK, PIVOTS = 2048, 256
#: Sampled points for a pivot of the net, half of what a group is expected to give.
SAMPLE = 4
#: Room for rounding in the bounds; the points' own cosine decides at the threshold.
EPS = 1e-9
#: Below this radius the points of a node are leaves (scaled copies of one vector).
FINEST = 1e-6
#: Groups whose sizes are broadcast (a name and two numbers each); more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def distances(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines and distances of unit vectors."""
    cos = a @ b.T
    return cos, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos))


class Tree(NamedTuple):
    """A cover tree; points are permuted so that a node's points are one range."""
    points: np.ndarray   # unit vectors, permuted
    order: np.ndarray    # place of each point in the input
    center: np.ndarray   # node -> place of its center in ``points``
    start: np.ndarray    # node -> first point
    end: np.ndarray      # node -> one past the last point
    radius: np.ndarray   # node -> largest distance of its points from the center
    kids: list           # node -> array of child nodes; empty for a point


def cover_tree(x: np.ndarray) -> Tree:
    """Nested nets with halving radii; the center of a node is the center of its first child."""
    order, center, start, end, radius, kids = [], [], [], [], [], []

    def node(c: int, r: float) -> int:
        center.append(c), start.append(len(order)), end.append(0), radius.append(r), kids.append([])
        return len(center) - 1

    # (parent, center, points, their distances from it); children are made in depth-first order.
    todo = [(-1, 0, np.arange(len(x)), distances(x[:1], x)[1][0])] if len(x) else []
    while todo:
        parent, c, pts, d = todo.pop()
        far = float(d.max())
        me = node(c, 0.0 if len(pts) == 1 else far)
        if parent >= 0:
            kids[parent].append(me)
        if len(pts) == 1:
            order.append(c)
            continue
        made = []
        step = far / 2
        left, at, dist = pts, c, d
        while len(left):
            near = dist <= step if far > FINEST else left == at
            near |= left == at
            made.append((me, at, left[near], dist[near]))
            left = left[~near]
            if len(left):
                at = left[0]
                dist = distances(x[at:at + 1], x[left])[1][0]
        todo.extend(reversed(made))
    order = np.array(order, dtype=np.int64)
    # A node's points follow it in depth-first order: its end is where the next node outside it starts.
    sizes = np.ones(len(center), dtype=np.int64)
    for i in range(len(center) - 1, -1, -1):
        if kids[i]:
            sizes[i] = sum(sizes[k] for k in kids[i])
    start = np.array(start, dtype=np.int64)
    place = np.empty(len(x), dtype=np.int64)
    place[order] = np.arange(len(x))
    return Tree(x[order], order, place[np.array(center, dtype=np.int64)], start, start + sizes,
                np.array(radius), [np.array(k, dtype=np.int64) for k in kids])


class Links:
    """Weighted link counts of the points of two trees and what connects them."""

    def __init__(self, weights: np.ndarray):
        self.before = np.concatenate([[0], np.cumsum(weights)])
        self.change = np.zeros(len(weights) + 1, dtype=np.int64)
        self.weights = weights
        self.up = np.arange(len(weights))
        self.whole: set[tuple[int, int]] = set()

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)

    def connect(self, s: int, e: int) -> None:
        """All points of a range are connected (through the other side, or each other)."""
        if e - s > 1 and (s, e) not in self.whole:
            self.whole.add((s, e))
            for i in range(s + 1, e):
                self.join(s, i)

    def blocks(self, s1: int, e1: int, s2: int, e2: int) -> None:
        """All points of one range are linked with all of the other."""
        for s, e, t, f in ((s1, e1, s2, e2), (s2, e2, s1, e1)):
            w = self.before[f] - self.before[t]
            self.change[s] += w
            self.change[e] -= w
            self.connect(s, e)
        self.join(s1, s2)

    def within(self, s: int, e: int) -> None:
        """All points of a range are linked with each other; a point not with itself."""
        w = self.before[e] - self.before[s]
        self.change[s] += w
        self.change[e] -= w
        self.connect(s, e)

    def counts(self, selfs: np.ndarray) -> np.ndarray:
        return np.cumsum(self.change[:-1]) - selfs * self.weights


def traverse(a: Tree, b: Tree | None, weights: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of the points of ``a`` and then of ``b`` (in the trees' order) over all pairs
    between the trees, or within ``a`` where ``b`` is None; a point is not linked with itself."""
    tau = float(np.sqrt(2.0 - 2.0 * threshold))
    links = Links(weights)
    selfs = np.zeros(len(weights), dtype=np.int64)   # pairs of a point with itself that were counted
    shift, other = (0, a) if b is None else (len(a.order), b)
    todo = [(0, 0)]
    while todo:
        m, n = todo.pop()
        same = b is None and m == n
        if same and a.radius[m] * 2 <= tau - EPS:
            links.within(a.start[m], a.end[m])
            selfs[a.start[m]:a.end[m]] += 1
            continue
        ms = a.kids[m] if len(a.kids[m]) else np.array([m])
        ns = ms if same else other.kids[n] if len(other.kids[n]) else np.array([n])
        # Open the wider node only, where the other is much narrower.
        if not same and len(a.kids[m]) and len(other.kids[n]):
            if a.radius[m] > 2 * other.radius[n]:
                ns = np.array([n])
            elif other.radius[n] > 2 * a.radius[m]:
                ms = np.array([m])
        cos, d = distances(a.points[a.center[ms]], other.points[other.center[ns]])
        reach = a.radius[ms][:, None] + other.radius[ns][None, :]
        points = reach == 0
        whole = np.where(points, cos >= threshold, d + reach <= tau - EPS)
        open_ = ~points & ~whole & (d <= tau + reach + EPS)
        if same:
            whole, open_ = np.triu(whole, 1), np.triu(open_, 1)
            # A child with itself: its own pairs.
            todo.extend((int(k), int(k)) for k in ms if len(a.kids[k]))
        for i, j in zip(*np.nonzero(whole)):
            links.blocks(a.start[ms[i]], a.end[ms[i]], shift + other.start[ns[j]], shift + other.end[ns[j]])
        todo.extend((int(ms[i]), int(ns[j])) for i, j in zip(*np.nonzero(open_)))
    return links.counts(selfs), np.array([links.root(i) for i in range(len(weights))])


def net(x: np.ndarray, most: int) -> np.ndarray:
    """Places of at most ``most`` points of a nested net: the finest level of halving radii that fits."""
    def level(radius: float, first: list[int]) -> list[int] | None:
        far = np.full(len(x), np.inf)
        out = list(first)
        for i in out:
            far = np.minimum(far, distances(x[i:i + 1], x)[1][0])
        while True:
            i = int(np.argmax(far > radius)) if (far > radius).any() else -1
            if i < 0:
                return out
            if len(out) == most:
                return None
            out.append(i)
            far = np.minimum(far, distances(x[i:i + 1], x)[1][0])

    found, radius = [0], 2.0
    while radius > FINEST:
        finer = level(radius, found)
        if finer is None:
            break
        found, radius = finer, radius / 2
    # Fill the next level up to the limit: farthest points first.
    far = np.min([distances(x[i:i + 1], x)[1][0] for i in found], axis=0)
    while len(found) < most and far.max() > FINEST:
        i = int(np.argmax(far))
        found.append(i)
        far = np.minimum(far, distances(x[i:i + 1], x)[1][0])
    return np.array(found)


def _matrix(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1)[:, None]


def _usable(v: Column, label: Column) -> Column:
    """Whether a vector can link at all."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _choose(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pivots of a group from its sample."""
    x = _matrix(pdf["vec"])
    return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "pivots": [x[net(x, int(pdf["most"].iloc[0]))].ravel()]})


def _home(points: pd.DataFrame, tile: pd.DataFrame) -> pd.DataFrame:
    """The nearest pivot of each point and its distance."""
    x = _matrix(points["vec"])
    d = distances(x, tile["pivots"].iloc[0].reshape(-1, x.shape[1]))[1]
    return points[["grp", "tile", "key", "weight", "vec"]].assign(
        cell=d.argmin(axis=1).astype(np.int32), dist=d.min(axis=1))


def _reach(points: pd.DataFrame, tile: pd.DataFrame, tau: float) -> pd.DataFrame:
    """The cells that may hold a neighbour of each point, its own included unless it is a clique."""
    x = _matrix(points["vec"])
    p = tile["pivots"].iloc[0].reshape(-1, x.shape[1])
    radii, blocks = np.asarray(tile["radii"].iloc[0]), np.asarray(tile["blocks"].iloc[0])
    p, own = p[:len(radii)], points["cell"].to_numpy()
    # Its covering ball holds a point within tau of this one, and meets the own cell's ball.
    held = distances(x, p)[1] <= radii + tau + EPS
    held &= (distances(p, p)[1] <= radii[:, None] + radii[None, :] + tau + EPS)[own]
    held &= blocks > 0
    held[np.arange(len(x)), own] = (2 * radii > tau - EPS)[own]
    reach = [[{"q": int(q), "n": int(blocks[q])} for q in np.nonzero(h)[0]] for h in held]
    return points[["key", "weight", "vec", "cell"]].assign(
        grp=points["grp"], mine=blocks[own].astype(np.int32), reach=reach)


def _meet(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of the points of two blocks, or of one block with itself."""
    first = pdf["first"].to_numpy(dtype=bool)
    sides = [pdf] if bool(pdf["alone"].iloc[0]) else [pdf[first], pdf[~first]]
    if not all(len(s) for s in sides):
        return pd.DataFrame({"key": [], "links": [], "root": []}).astype("int64")
    trees = [cover_tree(_matrix(s["vec"])) for s in sides]
    parts = [s.iloc[t.order] for s, t in zip(sides, trees)]
    keys = np.concatenate([p["key"].to_numpy(dtype=np.int64) for p in parts])
    weights = np.concatenate([p["weight"].to_numpy(dtype=np.int64) for p in parts])
    links, root = traverse(trees[0], trees[1] if len(trees) > 1 else None, weights, threshold)
    some = links > 0
    return pd.DataFrame({"key": keys[some], "links": links[some], "root": keys[root[some]]})


def _cells(points: DataFrame, sizes: DataFrame, tau: float, block: int) -> tuple[DataFrame, DataFrame]:
    """For the points of groups over ``block``: (what is sent to pairs of blocks, members of cliques)."""
    # Points by hash, and one of each group in any case.
    sample = points.filter((F.pmod(F.xxhash64("key", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
                            < 2.0 * SAMPLE * F.col("most") / F.col("n")) | (F.col("key") == F.col("head")))
    pivots = written(sample.select("grp", "most", "vec").groupBy("grp")
                     .applyInPandas(_choose, "grp string, pivots array<double>"), "pivots")
    tiles = sizes.select("grp", F.explode(F.expr(f"sequence(0, cast(ceil(n / {block}) AS INT) - 1)")).alias("tile"))
    tiled = points.select("grp", "key", "weight", "vec", F.pmod(F.xxhash64("key", F.lit(3)), F.ceil(F.col("n") / block))
                          .cast("int").alias("tile"))
    homed = written(tiled.groupBy("grp", "tile").cogroup(tiles.join(pivots, "grp").groupBy("grp", "tile")).applyInPandas(
        _home, "grp string, tile int, key bigint, weight bigint, vec array<double>, cell int, dist double"), "homes")
    cells = written(homed.groupBy("grp", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("total"), F.max("dist").alias("radius"),
        F.min("key").alias("head")), "cells")
    split = cells.groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct(
        "cell", F.struct("radius", F.ceil(F.col("n") / block).cast("int").alias("blocks"))))).alias("m"))
    top = "sequence(0, array_max(map_keys(m)))"
    split = split.select("grp", F.expr(f"transform({top}, i -> coalesce(m[i].radius, -9D))").alias("radii"),
                         F.expr(f"transform({top}, i -> coalesce(m[i].blocks, 0))").alias("blocks"))
    reached = homed.groupBy("grp", "tile").cogroup(
        tiles.join(pivots, "grp").join(split, "grp").groupBy("grp", "tile")).applyInPandas(
        lambda p, t: _reach(p, t, tau),
        "grp string, key bigint, weight bigint, vec array<double>, cell int, mine int, reach array<struct<q int, n int>>")
    sent = reached.withColumn("b", F.expr("CAST(pmod(xxhash64(key, 5), mine) AS INT)"))
    sent = sent.select("grp", "key", "weight", "vec", "cell", "b", F.explode("reach").alias("r"))
    sent = sent.select("*", F.explode(F.expr("sequence(0, r.n - 1)")).alias("j"))
    # A pair of blocks is named by the lesser (cell, block) first; that side is ``first``.
    sent = sent.withColumn("first", F.expr("cell < r.q OR (cell = r.q AND b <= j)"))
    mine, theirs = "concat(cell, '.', b)", "concat(r.q, '.', j)"
    sent = sent.select(
        F.expr(f"concat(grp, '/', IF(first, {mine}, {theirs}), '/', IF(first, {theirs}, {mine}))").alias("task"),
        "first", F.expr("cell = r.q AND b = j").alias("alone"), "key", "weight", "vec")
    cliques = (homed.select("grp", "cell", "key", "weight")
               .join(cells.filter(F.col("radius") * 2 <= tau - EPS).select("grp", "cell", "total", "head"), ["grp", "cell"])
               .select("key", (F.col("total") - F.col("weight")).alias("links"), F.col("head").alias("root")))
    return sent, cliques


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: see the contract of op12."""
    ship(vectors)
    tau = float(np.sqrt(2.0 - 2.0 * threshold))
    given = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"),
                           F.col(label_col).alias("label"))
    ok = _usable(F.col("vec"), F.col("label"))
    rows = written(given.select(
        "vec_id", F.when(ok, F.xxhash64("label", "vec")).alias("key"),
        F.when(ok, F.concat_ws(":", F.size("vec").cast("string"), F.col("label").cast("string"))).alias("grp"),
        F.when(ok, F.col("vec")).alias("vec")), "vectors")
    # Equal vectors of a label are one point.
    points = written(rows.filter("key IS NOT NULL").groupBy("grp", "key")
                     .agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"),
                          F.first("vec").alias("vec")), "points")
    sizes = points.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("head"))
    sizes = written(sizes.withColumn("most", F.least(F.ceil(F.col("n") / block), F.lit(PIVOTS)).cast("int")), "sizes")
    hint = F.broadcast if sizes.count() <= BROADCAST_ROWS else (lambda df: df)
    narrow = points.select("grp", "key", "weight", "vec").join(hint(sizes), "grp")
    sent = narrow.filter("most = 1").select(F.col("grp").alias("task"), F.lit(True).alias("first"),
                                            F.lit(True).alias("alone"), "key", "weight", "vec")
    big, cliques = sizes.filter("most > 1"), None
    if not big.isEmpty():
        more, cliques = _cells(narrow.filter("most > 1"), big, tau, block)
        sent = sent.unionByName(more)
    links = sent.groupBy("task").applyInPandas(lambda pdf: _meet(pdf, threshold), "key bigint, links bigint, root bigint")
    if cliques is not None:
        links = links.unionByName(cliques)
    links = written(links, "links")
    roots = connected_components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    known = (points.select("key", "weight", "least").join(counts, "key", "left")
             .join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
             .select("key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("root", "key").alias("root"), "least"))
    known = written(known, "linked")
    named = (known.join(known.groupBy("root").agg(F.min("least").alias("component_id")), "root")
             .select("key", "n_links", "component_id"))
    # A hot key (a vector with very many copies) is split by the adaptive skew join.
    out = rows.select("vec_id", "key").join(named, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", F.when(F.col("key").isNull(), F.col("vec_id"))).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
