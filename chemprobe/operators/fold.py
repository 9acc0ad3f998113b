"""Approximate minimum-free-energy folding. Energies are a simplified stacking model, not a thermodynamic
package's: structures of distinct sequences are computed once and joined back."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# kcal/mol of a base pair stacked on a neighbouring pair, by the inner pair.
PAIR_ENERGY = {"GC": -3.3, "CG": -3.3, "AU": -2.1, "UA": -2.1, "GU": -1.4, "UG": -1.4}
LOOP, LEAST_LOOP = 4.1, 3


def fold(seq: str) -> tuple[float, str]:
    """(energy, dot-bracket) of the best nested structure of helices; 0.0 and dots if nothing gains."""
    s = seq.upper().replace("T", "U")
    n = len(s)
    best = np.zeros((n + 1, n + 1))
    shut = np.full((n + 1, n + 1), np.inf)
    for span in range(LEAST_LOOP + 1, n):
        for i in range(n - span):
            j = i + span
            e = PAIR_ENERGY.get(s[i] + s[j])
            if e is not None:
                inner = shut[i + 1, j - 1] + e if span > LEAST_LOOP + 2 else np.inf
                shut[i, j] = min(inner, LOOP, best[i + 1, j - 1] + LOOP)
            ks = np.arange(i, j)
            split = (best[i, ks] + best[ks + 1, j]).min()
            best[i, j] = min(split, shut[i, j], 0.0)
    out, stack = ["."] * n, [(0, n - 1, False)]
    while stack:
        i, j, closed = stack.pop()
        if j - i <= LEAST_LOOP or (not closed and best[i, j] >= 0):
            continue
        if closed or np.isclose(best[i, j], shut[i, j]):
            out[i], out[j] = "(", ")"
            e = PAIR_ENERGY[s[i] + s[j]]
            if j - i > LEAST_LOOP + 2 and np.isclose(shut[i, j], shut[i + 1, j - 1] + e):
                stack.append((i + 1, j - 1, True))
            elif best[i + 1, j - 1] < 0:
                stack.append((i + 1, j - 1, False))
            continue
        ks = np.arange(i, j)
        k = int(ks[(best[i, ks] + best[ks + 1, j]).argmin()])
        stack += [(i, k, False), (k + 1, j, False)]
    return float(best[0, n - 1]) if n else 0.0, "".join(out)


def structures(seqs: DataFrame, column: str = "sequence", ledger: DataFrame | None = None) -> DataFrame:
    """(sequence, deltaG, structure) of distinct sequences; those in `ledger` are not folded again."""
    new = seqs.select(F.col(column).alias("sequence")).where("sequence IS NOT NULL").distinct()
    todo = new.join(ledger, "sequence", "left_anti") if ledger is not None else new

    def run(batches):
        for batch in batches:
            rows = [fold(x) for x in batch["sequence"]]
            yield pd.DataFrame({"sequence": batch["sequence"], "deltaG": [e for e, _ in rows], "structure": [t for _, t in rows]})

    done = todo.mapInPandas(run, "sequence string, deltaG double, structure string")
    return done.unionByName(ledger.join(new, "sequence", "left_semi")) if ledger is not None else done
