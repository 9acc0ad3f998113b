"""Statistics over groups, as aggregates without collecting a group's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _with_rank(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Distinct values with their count, the number of rows before them and in all."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_k"))
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    before = F.coalesce(F.sum("_k").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted.withColumn("_before", before).withColumn("_n", F.sum("_k").over(w))


def gini(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The Gini index of non-negative values per group, from sorted distinct values and their counts."""
    r = _with_rank(df, group, value)
    # a run of k equal values at ranks before+1 ... before+k: the sum of (2 rank - n - 1) is k (2 before + k - n)
    spread = F.sum(F.col(value) * F.col("_k") * (2 * F.col("_before") + F.col("_k") - F.col("_n")))
    total = F.sum(F.col(value) * F.col("_k"))
    return r.groupBy(*group).agg(F.try_divide(spread, F.max("_n") * total).alias("gini"))


def auc(df: DataFrame, group: list[str], value: str, positive: str) -> DataFrame:
    """Area under the ROC curve per group: the rank statistic, ties counting half."""
    counted = df.where(F.col(value).isNotNull() & F.col(positive).isNotNull()).groupBy(*group, value).agg(
        F.count(F.when(F.col(positive), 1)).alias("_p"), F.count(F.when(~F.col(positive), 1)).alias("_q")
    )
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    below = F.coalesce(F.sum("_q").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s = counted.withColumn("_b", below)
    return s.groupBy(*group).agg(F.try_divide(F.sum(F.col("_p") * (F.col("_b") + F.col("_q") / 2)), F.sum("_p") * F.sum("_q")).alias("auc"))


def wilson(successes: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Ends of the Wilson interval of a proportion; null where n is 0."""
    p = F.try_divide(successes, n)
    scale = 1 + F.try_divide(F.lit(z * z), n)
    middle = (p + F.try_divide(F.lit(z * z / 2), n)) / scale
    half = F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(z * z / 4), n * n)) * z / scale
    return middle - half, middle + half


def linear_fit(df: DataFrame, group: list[str], x: str, y: str) -> DataFrame:
    """Least squares per group: slope, intercept, r2 and rmse, in one pass."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.sqrt(F.greatest(F.regr_syy(y, x) - F.try_divide(F.pow(F.regr_sxy(y, x), 2), F.regr_sxx(y, x)), F.lit(0.0)) / F.count(F.lit(1))).alias("rmse"),
    )


#: Models that `nonlinear_fit` knows, by name: value for an array x and parameters.
def models() -> dict:
    import numpy as np

    return {
        "linear": lambda x, a, b: a * x + b,
        "exponential": lambda x, a, b: a * np.exp(b * x),
        "saturation": lambda x, a, b: a * x / (b + x),
        "sigmoid": lambda x, a, b, c: a / (1 + np.exp(-(x - b) * c)),
    }


def nonlinear_fit(x, y, model: str, start, rounds: int = 200) -> tuple:
    """Levenberg-Marquardt fit of a named model to arrays: parameters and r2. Never evaluates text."""
    import numpy as np

    f, p, damp = models()[model], np.array(start, float), 1e-3
    x, y = np.asarray(x, float), np.asarray(y, float)
    cost = np.square(f(x, *p) - y).sum()
    for _ in range(rounds):
        base = f(x, *p)
        steps = 1e-6 * np.maximum(np.abs(p), 1e-3)
        j = np.stack([(f(x, *(p + np.eye(len(p))[k] * h)) - base) / h for k, h in enumerate(steps)], axis=1)
        a, g = j.T @ j, j.T @ (y - base)
        new = p + np.linalg.solve(a + damp * np.diag(np.diag(a) + 1e-12), g)
        after = np.square(f(x, *new) - y).sum()
        if after < cost:
            done = cost - after < 1e-14 * max(cost, 1e-300)
            p, cost, damp = new, after, damp / 3
            if done:
                break
        else:
            damp *= 4
            if damp > 1e12:
                break
    total = np.square(y - y.mean()).sum()
    return p, (1 - cost / total if total else float("nan"))
