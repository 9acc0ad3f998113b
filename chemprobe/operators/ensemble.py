"""Partition function and pairing probabilities of sequences, in the energy model of `fold`.

Every nested structure of helices has one derivation: a pair that is stacked on the next one inside takes the
stacking energy, any other pair closes a loop. Weights are summed from the inside out, then from the outside
in; both take time of the third power of the length, most of it in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemprobe.operators.fold import LEAST_LOOP, LOOP, PAIR_ENERGY

#: kcal/(mol K).
GAS = 0.0019872


def pair_probabilities(seq: str, temperature: float = 310.15) -> tuple[float, np.ndarray]:
    """(ensemble energy, matrix of pairing probabilities) of a sequence; the matrix is symmetric."""
    s = seq.upper().replace("T", "U")
    n, rt = len(s), GAS * temperature
    if not n:
        return 0.0, np.zeros((0, 0))
    loop = np.exp(-LOOP / rt)
    stack = np.zeros((n, n))
    for i in range(n):
        for j in range(i + LEAST_LOOP + 1, n):
            if (e := PAIR_ENERGY.get(s[i] + s[j])) is not None:
                stack[i, j] = np.exp(-e / rt)
    # open[i, j + 1]: all structures of i to j, the empty one included; shut[i, j]: those with i and j paired
    open_, shut = np.tril(np.ones((n + 1, n + 1))).T + np.tril(np.ones((n + 1, n + 1)), -1), np.zeros((n, n))
    for span in range(LEAST_LOOP + 1, n):
        for i in range(n - span):
            j = i + span
            if stack[i, j]:
                inner = shut[i + 1, j - 1] if span > LEAST_LOOP + 2 else 0.0
                shut[i, j] = loop * (open_[i + 1, j] - inner) + stack[i, j] * inner
            ks = np.arange(i, j - LEAST_LOOP)
            open_[i, j + 1] = open_[i, j] + open_[i, ks] @ shut[ks, j]
    total = open_[0, n]
    outer = np.zeros((n, n))
    for i in range(n):
        # of pairs (k, l) around i: what lies between k and i, for each l
        left = open_[1 : i + 1, i] @ (outer[:i] * (stack[:i] > 0)) * loop if i else np.zeros(n)
        for j in range(n - 1, i + LEAST_LOOP, -1):
            if not stack[i, j]:
                continue
            ls = np.arange(j + 1, n)
            out = open_[0, i] * open_[j + 1, n] + left[ls] @ open_[j + 1, ls]
            if i and j + 1 < n and stack[i - 1, j + 1] and j - i + 2 > LEAST_LOOP + 2:
                out += outer[i - 1, j + 1] * (stack[i - 1, j + 1] - loop)
            outer[i, j] = out
    p = outer * shut / total
    return float(-rt * np.log(total)), p + p.T


def ensembles(seqs: DataFrame, column: str = "sequence", temperature: float = 310.15, least: float = 0.0) -> DataFrame:
    """(sequence, ensemble_energy, paired, pairs) of distinct sequences, in distributed tasks.

    paired: each position's probability to be in a pair; pairs: (i, j, p), 1-based, of at least `least`. Null
    sequences are passed over; the empty one has no pairs. Other options that folding programs take (fold
    arguments, reactivities as restraints) are not part of this model.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for seq in batch["sequence"]:
                energy, p = pair_probabilities(seq, temperature)
                found = [(int(i) + 1, int(j) + 1, float(p[i, j])) for i, j in np.argwhere(np.triu(p) > 0) if p[i, j] >= least]
                rows.append((seq, energy, p.sum(axis=1).tolist(), [dict(zip("ijp", x)) for x in found]))
            yield pd.DataFrame(rows, columns=["sequence", "ensemble_energy", "paired", "pairs"])

    schema = "sequence string, ensemble_energy double, paired array<double>, pairs array<struct<i:int,j:int,p:double>>"
    distinct = seqs.select(F.col(column).alias("sequence")).where("sequence IS NOT NULL").distinct()
    return distinct.mapInPandas(run, schema)
