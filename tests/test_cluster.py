"""The mixture model: its probabilities by enumeration, its rates by simulation, its likelihood by ascent."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from chemprobe.operators import cluster as cl


def spaced(p):
    at = [i for i, x in enumerate(p) if x]
    return all(b - a > cl.GAP for a, b in zip(at, at[1:]))


def test_seen_probability_by_enumeration():
    rng = np.random.default_rng(0)
    mu = rng.beta(1.5, 8, 10)
    weight = {p: np.prod([m if x else 1 - m for m, x in zip(mu, p)]) for p in itertools.product((0, 1), repeat=10) if spaced(p)}
    d, s = cl.seen_probability(mu)
    assert d == pytest.approx(sum(weight.values()))
    for i in range(10):
        assert mu[i] * s[i] == pytest.approx(sum(w for p, w in weight.items() if p[i]))


@pytest.mark.parametrize("n,a,b", [(12, 1.5, 20), (50, 2, 6), (60, 2, 3)])
def test_rates_are_recovered(n, a, b):
    mu = np.random.default_rng(n).beta(a, b, n)
    mu[::7] = 0
    d, s = cl.seen_probability(mu)
    assert np.allclose(cl.unbiased_rates(mu * s / d), mu, atol=1e-7)


def simulated(spark, n=3000):
    rng = np.random.default_rng(7)
    mu = np.zeros((2, 24))
    mu[0, [1, 9, 17]], mu[1, [4, 12, 21]] = 0.3, 0.35
    mu += 0.01
    reads, which = [], []
    while len(reads) < n:
        k = int(rng.random() < 0.4)
        p = (rng.random(24) < mu[k]).astype(int)
        if spaced(p):
            reads.append((len(reads), "".join(map(str, p))))
            which.append(k)
    return spark.createDataFrame(reads, "read long, pattern string"), np.array(which)


def test_two_clusters(spark):
    reads, which = simulated(spark)
    patterns = reads.groupBy("pattern").agg(F.count("*").alias("n"))
    found = cl.runs(patterns, list(range(24)), 24, cl.Options(max_clusters=2, num_runs=3, min_iter=5, max_iter=60))
    rows = found.collect()
    assert sorted((r["k"], r["run"]) for r in rows) == [(1, 0), (2, 0), (2, 1), (2, 2)]
    best = {r["k"]: r for r in cl.best(found).collect()}
    assert best[2]["ll"] == max(r["ll"] for r in rows if r["k"] == 2) > best[1]["ll"] and best[2]["bic"] < best[1]["bic"]
    assert min(best[2]["pi"]) == pytest.approx(0.4, abs=0.06)
    m = cl.membership(reads, found, list(range(24)))
    assert m.groupBy("read", "k").agg(F.sum("p").alias("s")).where("abs(s - 1) > 1e-9").count() == 0
    p = {r["read"]: r["p"] for r in m.where("k = 2 AND i = 1").collect()}
    guess = np.array([p[i] > 0.5 for i in range(len(which))])
    assert max((guess == which).mean(), (guess != which).mean()) > 0.8


def test_likelihood_rises():
    rng = np.random.default_rng(1)
    x = np.array([p for p in (rng.random((400, 15)) < 0.08).astype(float) if spaced(p)])
    path = cl.fit(x, np.ones(len(x)), 2, 3, cl.Options(min_iter=25, max_iter=30), np.arange(15), 15)["path"]
    assert all(b >= a - 1e-6 for a, b in zip(path, path[1:]))
