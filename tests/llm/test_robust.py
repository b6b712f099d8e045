"""The minimum covariance determinant over groups against numpy, one group at a time."""

import numpy as np
import pytest

from vatio.llm import quality_rules as q

P = len(q.STATISTICS)


def far_of(x, mu, prec):
    d = x / q.GRID - mu
    return np.einsum("ij,jk,ik->i", d, prec, d)


def scatter_of(x, share):
    x = x / q.GRID
    return x.mean(axis=0), q.consistency(share, P) * np.cov(x.T, bias=True) + np.diag(np.square(q.FLOORS))


def step(x, mu, scatter):
    far = np.floor(np.log2(1 + far_of(x, mu, np.linalg.inv(scatter))) * 64)
    return scatter_of(x[far <= np.quantile(far, q.SHARE)], q.SHARE)


def logdet(estimate):
    return np.linalg.slogdet(estimate[1])[1]


def converged(x, estimate):
    while True:
        after = step(x, *estimate)
        if logdet(after) >= logdet(estimate) - q.CONVERGED:
            return estimate
        estimate = after


def starts(x):
    mid = np.median(x, axis=0)
    sd = np.sqrt(np.square(np.median(np.abs(x - mid), axis=0) * 1.4826 / q.GRID) + np.square(q.FLOORS))
    bent = np.round(np.tanh((x - mid) / q.GRID / sd) * q.GRID)
    out = []
    for kind, y in ((1, x), (2, bent)):
        out += [e[1:] for e in q.starts_from(kind, y.mean(axis=0) / q.GRID, np.cov((y / q.GRID).T, bias=True), mid / q.GRID, sd)]
    return out


def estimate(x):
    trials = []
    for e in starts(x):
        for _ in range(q.TRIAL_STEPS):
            e = step(x, *e)
        trials.append(e)
    best = converged(x, min(trials, key=logdet))
    inner = x[far_of(x, best[0], np.linalg.inv(best[1])) <= q.chi_square_quantile(0.025, P)]
    return scatter_of(inner, 0.975), best, trials


def sample(seed, n, bad):
    """Correlated statistics, of which a share lies in a clump of its own."""
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(P, P)) * 0.3 + np.eye(P)
    x = rng.normal(size=(n, P)) @ mix
    k = int(n * bad)
    x[:k] = rng.normal(size=(k, P)) * 0.1 + 6
    return np.floor(x * q.GRID * 0.4 + 0.5).astype(np.int64) + 3 * q.GRID


@pytest.fixture(scope="module")
def groups():
    return {"a": sample(1, 400, 0.0), "b": sample(2, 300, 0.2), "c": sample(3, 200, 0.24), "d": sample(4, 12, 0.0),
            "e": np.full((30, P), 5 * q.GRID)}


@pytest.mark.parametrize("limit", [q.BROADCAST_BYTES, 0])
def test_estimates_equal_numpy(spark, groups, monkeypatch, limit):
    monkeypatch.setattr(q, "BROADCAST_BYTES", limit)
    rows = [(g, *map(int, r)) for g, x in groups.items() for r in x]
    df = spark.createDataFrame(rows, ["grp", *[f"x{i}" for i in range(P)]]).repartition(3)
    got = {r["grp"]: r for r in q.estimates(df).collect()}
    assert got.keys() == groups.keys()
    for g, x in groups.items():
        (mu, scatter), _, _ = estimate(x)
        assert np.allclose(got[g]["mu"], mu, atol=1e-6), g
        assert np.allclose(np.array(got[g]["prec"]).reshape(P, P), np.linalg.inv(scatter), rtol=1e-4, atol=1e-5), g


def test_the_smallest_determinant_wins_and_holds(groups):
    for g in "abc":
        x = groups[g]
        _, best, trials = estimate(x)
        assert all(logdet(best) <= logdet(t) + 1e-9 for t in trials)
        assert logdet(step(x, *best)) >= logdet(best) - q.CONVERGED
    x = groups["c"]     # a clump of a quarter of the rows does not pull the estimate
    (mu, scatter), _, _ = estimate(x)
    far = far_of(x, mu, np.linalg.inv(scatter))
    assert far[:48].min() > q.chi_square_quantile(q.TAIL, P) and np.median(far[48:]) < q.chi_square_quantile(0.05, P)
