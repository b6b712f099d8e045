"""Lexical search, embedding near-dedup and spelling variants against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import LONG, ODD
from vatio.llm import embedding_dedup, lexical_search, spelling

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- lexical search ------------------------------------------------------------------------------

def ranked(docs, items, top=10):
    tfs = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    tfs = [(i, tf, sum(tf.values())) for i, tf in tfs if tf]
    n_docs, n_terms = len(tfs), sum(n for _, _, n in tfs)
    df = Counter(t for _, tf, _ in tfs for t in tf)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, tf, n in tfs:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t in TERM.findall((text or "").translate(LOWER)) if t in tf)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top])]
    return sorted(out, key=str)


def search(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in lexical_search.search(d, i, **kw).select("item_id", "rank", "doc_id", "score")
                   .collect()), key=str)


ITEMS = [(0, "quick Fox QUICK dog"), (1, "word5 word6 word7 ß"), (2, ""), (3, None), (4, "nothing-here xyzzy"),
         (None, "lazy lazy wörter"), (0, "zwei Wörter"), (0, "quick Fox QUICK dog")]


def test_search_odd_rows(spark):
    docs = [(r[0], r[1]) for r in ODD]
    assert search(spark, docs, ITEMS) == ranked(docs, ITEMS)


def test_search_is_exact_when_every_bound_is_loose(spark, monkeypatch):
    """Few coordinates and small rounds: many bounds lie above the threshold, none may be lost."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 80)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]          # a group of copies: ties by id
    docs += [(2000 + i, docs[9][1] + f" extra{i}") for i in range(60)]
    items = [(k, " ".join(rng.choices(words, k=12))) for k in range(6)] + [(6, docs[7][1]), (7, docs[9][1])]
    expected = ranked(docs, items)
    monkeypatch.setattr(lexical_search, "FIRST_ROUND", 2)
    monkeypatch.setattr(lexical_search, "GROWTH", 2)
    assert search(spark, docs, items, width=64) == expected
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 30)      # several blocks of queries
    assert search(spark, docs, items) == expected


def test_search_finds_all_copies_of_a_text_that_few_tasks_proposed(spark, monkeypatch):
    """Copies lie behind documents of higher bounds and lower scores in other tasks."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    query = " ".join(words[:10])
    docs = [(1000 - i, query + f" tail{i % 2}") for i in range(8)]
    docs += [(2000 + i, " ".join(rng.choices(words[10:], k=60))) for i in range(200)]
    items = [(0, query), (1, words[3])]
    monkeypatch.setattr(lexical_search, "FIRST_ROUND", 1)
    for width in (16, 200, 1 << 16):
        assert search(spark, docs, items, width=width) == ranked(docs, items)


def test_search_bounds_hold_and_frequencies_round_up():
    f = lexical_search.FREQUENCY
    assert (np.diff(f) > 0).all() and len(f) == 256
    block = lexical_search.Block([{"terms": [{"term": b"a", "w": 3, "times": 2}, {"term": b"b", "w": 5, "times": 1}]}])
    at = [zlib.crc32(t) % lexical_search.WIDTH for t in (b"a", b"b")]
    order = np.argsort(at)
    for tf in (1, 127, 128, 129, 5000, 10**6):
        code = int(np.searchsorted(f, tf))
        assert f[code] >= tf
        up = block.bounds([np.array(at, "<u2")[order].tobytes()], [bytes([code, code])], np.array([100]))
        assert up[0, 0] >= 11 * lexical_search.impact(tf, 100)


def test_search_empty_tables(spark):
    assert search(spark, [], ITEMS) == []
    assert search(spark, [(1, "a b"), (2, None)], []) == []
    assert search(spark, [(1, "a b"), (2, None)], [(1, "c")]) == []


# ---- embeddings ----------------------------------------------------------------------------------

def components(rows, threshold=0.98):
    """{row place: (links, component)} by comparing all pairs."""
    usable = {}
    for k, (_, v, label) in enumerate(rows):
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        a = np.array(v, dtype=np.float64)
        usable[k] = a / np.linalg.norm(a)
    links = defaultdict(set)
    for i in usable:
        for j in usable:
            if i != j and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]) \
                    and usable[i] @ usable[j] >= threshold:
                links[i].add(j)
    out = {}
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out[k] = (i, len(links[k]), min(ids) if ids else None, bool(ids) and i == min(ids))
    return Counter(out.values())


def dedup(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<float>, label int, key string, n_links int").repartition(3)
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept)
                   for r in embedding_dedup.near_duplicates(df, **kw).collect())


def sample(dims, n, seed=1):
    """Single vectors, chains, dense and wide groups, copies, scaled copies."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[: n // 3] = x[0] + rng.normal(size=(n // 3, dims)) * 0.02
    x[n // 3: n // 2] = x[n // 3] + rng.normal(size=(n // 2 - n // 3, dims)) * 0.17
    x[n // 2: n // 2 + 9] = x[0]
    x[n // 2 + 9: n // 2 + 12] = x[0] * 3
    x = x.astype(np.float32)
    return [(int(i), [float(v) for v in row], int(i % 3 == 0)) for i, row in enumerate(x)]


@pytest.mark.parametrize("block", [2048, 40])
def test_embeddings_equal_brute_force(spark, block):
    rows = sample(8, 420)
    assert dedup(spark, rows, block=block) == components(rows)


def test_embeddings_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None),
            (5, None, 0), (6, [], 0), (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0),
            (None, [2.0, 0.01], 0), (None, [5.0], 2), (None, None, None), (11, [1.0, 0.0, 0.0], 0), (12, [-1.0, 0.0], 0)]
    assert dedup(spark, rows) == components(rows)
    assert dedup(spark, []) == Counter()


@pytest.mark.parametrize("dims", [2, 16])
def test_cover_tree_covers_and_counts(dims):
    x = np.array([v for _, v, _ in sample(dims, 300)], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    t = embedding_dedup.cover_tree(x)
    assert sorted(t.order) == list(range(len(x)))
    for node, kids in enumerate(t.kids):
        pts = t.points[t.start[node]:t.end[node]]
        d = embedding_dedup.distances(t.points[t.center[node]][None], pts)[1][0]
        assert d.max() <= t.radius[node] + 1e-6
        if len(kids):
            assert t.start[kids[0]] == t.start[node] and t.end[kids[-1]] == t.end[node]
            assert (t.start[kids[1:]] == t.end[kids[:-1]]).all()
            if t.radius[node] > embedding_dedup.FINEST:
                assert (t.radius[kids] <= t.radius[node] / 2 + 1e-9).all()
    weights = np.arange(len(x)) % 3 + 1
    links, root = embedding_dedup.traverse(t, None, weights, 0.98)
    close = t.points @ t.points.T >= 0.98
    np.fill_diagonal(close, False)
    assert (links == (close * weights).sum(axis=1)).all()


# ---- spelling variants ---------------------------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            n[run[:at] + run[at + 1:] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    of = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in of.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(of[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def grouped(spark, docs):
    df = spark.createDataFrame([(*d, "x", 7) for d in docs], "doc_id long, text string, word string, n int").repartition(3)
    got = spelling.group_variants(spelling.count_words(df))
    return sorted((tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def typos(seed=2):
    rng = random.Random(seed)
    texts, base = [], ["".join(rng.choices(["ab", "ra", "ñÿ", "çe", "ll", "én", "SS", "O"], k=6)) for _ in range(25)]
    base += ["a" * k for k in (7, 8, 9, 23, 24, 25, 26)] + ["".join(rng.choices("abc", k=k)) for k in (24, 25, 40, 41)]
    for k, w in enumerate(base):
        texts += [f"{w}, {w}."] * (1 + 40 * (k % 3))
        for _ in range(4):
            i = rng.randrange(len(w))
            c = rng.choice("abñÿz")
            texts += [rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])] * rng.randrange(1, 4)
    return list(enumerate(texts))


def test_spelling_equals_brute_force(spark):
    docs = typos()
    expected = variants(docs)
    assert any(r[1] for r in expected)
    assert grouped(spark, docs) == expected


def test_spelling_chain_is_followed_to_its_last_form(spark):
    words = {"abcdefg": 3, "abcdefh": 40, "abcdexh": 500, "zzzzzzzz": 2}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.form, r.root) for r in spelling.group_variants(df).collect()}
    assert got == {"abcdefg": ("abcdefh", "abcdexh"), "abcdefh": ("abcdexh", "abcdexh"),
                   "abcdexh": (None, "abcdexh"), "zzzzzzzz": (None, "zzzzzzzz")}


def test_spelling_odd_rows(spark):
    docs = [(r[0], r[1]) for r in ODD] + [(20, LONG), (21, "x" * 5000 + " " + "x" * 5001), (22, "x" * 5000 + " " + "x" * 5001)]
    assert grouped(spark, docs) == variants(docs)
    assert grouped(spark, []) == []
