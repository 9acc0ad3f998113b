"""Bernoulli mixtures of reads by expectation maximisation, without adjacent mutations.

Reads with two mutations closer than four positions are never seen, so the likelihood of a pattern is
divided by the probability of seeing one at all. Reads are first grouped to distinct patterns with
counts; the runs for every number of clusters and start are independent tasks over that small table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = 3


@dataclass(frozen=True)
class Options:
    """Defaults of a clustering run. `polya_max` and `info_thresh` are accepted and have no effect."""

    max_clusters: int = 3
    num_runs: int = 10
    min_iter: int = 100
    max_iter: int = 500
    cutoff: float = 0.5
    signal_thresh: float = 0.005
    min_reads: int = 1000
    include_gu: bool = False
    include_del: bool = False
    seed: int = 0
    polya_max: int = 4
    info_thresh: float = 0.05


def seen_probability(mu: np.ndarray) -> tuple[float, np.ndarray]:
    """The probability that no two mutations lie within GAP positions, and for each position that of a
    mutation there with none near it, over all others' chances.

    suffix[i] is the probability for positions i and later; prefix the same from the other end.
    """
    n = len(mu)
    q = 1 - mu

    def tails(q: np.ndarray, mu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tail = np.ones(n + GAP + 1)
        after = np.ones(n)
        for i in range(n - 1, -1, -1):
            after[i] = q[i + 1 : i + 1 + GAP].prod() * tail[min(i + GAP + 1, n)]
            tail[i] = q[i] * tail[i + 1] + mu[i] * after[i]
        return tail, after

    tail, after = tails(q, mu)
    _, before = tails(q[::-1], mu[::-1])
    return float(tail[0]), after * before[::-1]


def unbiased_rates(observed: np.ndarray, tolerance: float = 1e-9, rounds: int = 2000) -> np.ndarray:
    """Rates whose seen reads show `observed`: a damped fixed point, then Newton if it has not settled."""
    mu = observed.copy()
    for _ in range(rounds):
        d, s = seen_probability(mu)
        miss = mu * s / d - observed
        if np.abs(miss).max(initial=0) < tolerance:
            return mu
        mu = np.clip(0.5 * mu + 0.5 * observed * d / np.maximum(s, 1e-300), 0, 1 - 1e-12)
    free = np.flatnonzero(observed > 0)
    for _ in range(50):
        d, s = seen_probability(mu)
        miss = (mu * s / d - observed)[free]
        if np.abs(miss).max(initial=0) < tolerance:
            return mu
        jac = np.empty((len(free), len(free)))
        for k, i in enumerate(free):
            h = max(1e-7, 1e-6 * mu[i])
            up = mu.copy()
            up[i] += h
            du, su = seen_probability(up)
            jac[:, k] = ((up * su / du - observed)[free] - miss) / h
        mu[free] = np.clip(mu[free] - np.linalg.lstsq(jac, miss, rcond=None)[0], 0, 1 - 1e-9)
    raise ArithmeticError("the rates do not settle")


def _normalised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = x.max(axis=1, keepdims=True)
    total = top[:, 0] + np.log(np.exp(x - top).sum(axis=1))
    return np.exp(x - total[:, None]), total


def responsibilities(x: np.ndarray, mu: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(cluster | pattern) and each pattern's log likelihood. x: patterns x positions, mu: clusters x positions."""
    safe = np.clip(mu, 1e-12, 1 - 1e-12)
    d = np.array([seen_probability(m)[0] for m in mu])
    logs = np.log(np.maximum(share, 1e-300)) - np.log(d) + x @ np.log(safe).T + (1 - x) @ np.log1p(-safe).T
    return _normalised(logs)


def fit(x: np.ndarray, counts: np.ndarray, k: int, seed: int, options: Options, places: np.ndarray, length: int) -> dict:
    """One run: rates (k x length), shares of all and of seen reads, log likelihoods per round.

    `places` are the columns' positions within the section; dropped positions have rate 0.
    """
    rng = np.random.default_rng(seed)
    full = np.zeros((len(x), length))
    full[:, places] = x
    mu = np.zeros((k, length))
    mu[:, places] = rng.beta(1.5, 20, (k, len(places)))
    seen = real = np.full(k, 1 / k)
    n, path = counts.sum(), []
    for t in range(options.max_iter):
        p, log = responsibilities(full, mu, seen)
        path.append(float(counts @ log))
        if t > options.min_iter and path[-1] - path[-2] <= options.cutoff:
            break
        w = p * counts[:, None]
        size = w.sum(axis=0)
        mean = (w.T @ full) / np.maximum(size, 1e-300)[:, None]
        mu = np.stack([unbiased_rates(m) for m in mean])
        seen = size / n
        real = seen / np.array([seen_probability(m)[0] for m in mu])
        real = real / real.sum()
    return {"mu": mu, "pi": real, "seen": seen, "path": path}


def bic(ll: float, n: float, parameters: int, k: int) -> float:
    return float(np.log(n) * parameters * k - 2 * ll)


def runs(patterns: DataFrame, places: list[int], length: int, options: Options = Options()) -> DataFrame:
    """All runs over `patterns` (pattern, n): k, run, ll, bic, n_iter, pi, mu (one array per cluster).

    One run of one cluster, and num_runs of each larger number, each with a seed of its own. The
    patterns go to every task with the function; their number is bounded by the reads of one section.
    """
    rows = patterns.select("pattern", "n").orderBy("pattern").toPandas()
    x = np.array([[c == "1" for c in p] for p in rows["pattern"]], float).reshape(len(rows), len(places))
    counts = rows["n"].to_numpy(float)
    spark = patterns.sparkSession
    at = np.array(places, int)
    todo = [(k, r, options.seed + 1000 * k + r) for k in range(1, options.max_clusters + 1) for r in range(1 if k == 1 else options.num_runs)]

    def run(batches):
        for batch in batches:
            out = []
            for k, r, seed in zip(batch["k"], batch["run"], batch["seed"]):
                found = fit(x, counts, int(k), int(seed), options, at, length)
                ll = found["path"][-1]
                out.append((k, r, ll, bic(ll, counts.sum(), len(at), int(k)), len(found["path"]), found["pi"].tolist(), found["mu"].tolist()))
            yield pd.DataFrame(out, columns=["k", "run", "ll", "bic", "n_iter", "pi", "mu"])

    jobs = spark.createDataFrame(todo, "k int, run int, seed long").repartition(len(todo), "k", "run")
    return jobs.mapInPandas(run, "k int, run int, ll double, bic double, n_iter int, pi array<double>, mu array<array<double>>")


def best(found: DataFrame) -> DataFrame:
    """The run of the highest log likelihood for each number of clusters."""
    top = F.max_by(F.struct("run", "ll", "bic", "n_iter", "pi", "mu"), F.struct("ll", -F.col("run")))
    return found.groupBy("k").agg(top.alias("b")).select("k", "b.*")


def membership(reads: DataFrame, found: DataFrame, places: list[int]) -> DataFrame:
    """(read, k, i, p): each read's share in cluster i of the best run of each k. reads: read, pattern."""
    models = [(r["k"], np.array(r["mu"]), np.array(r["pi"])) for r in best(found).collect()]  # one row per k
    at = np.array(places, int)

    def run(batches):
        for batch in batches:
            x = np.array([[c == "1" for c in p] for p in batch["pattern"]], float).reshape(len(batch), len(at))
            parts = []
            for k, mu, pi in models:
                full = np.zeros((len(batch), mu.shape[1]))
                full[:, at] = x
                p, _ = responsibilities(full, mu, pi)
                parts += [pd.DataFrame({"read": batch["read"], "k": k, "i": i + 1, "p": p[:, i]}) for i in range(k)]
            yield pd.concat(parts)

    kind = reads.schema["read"].dataType.simpleString()
    return reads.select("read", "pattern").mapInPandas(run, f"read {kind}, k int, i int, p double")
