"""Per-position and per-read reductions of mutation vectors.

Vectors are in long form: read, pos, base, b (0 ... 255), any number of key columns such as sample, ref
and section. All counters of a profile come from one scan with partial sums on each task, so the few
(key, pos) groups of amplicon data never gather their reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemprobe.functions.bits import mut_match
from chemprobe.functions.codes import DELET, INS_3, MATCH_INS5, SUB_N, SUBSTITUTION


def _sum(condition: Column) -> Column:
    return F.sum(condition.cast("long"))


def counters(b: Column) -> dict[str, Column]:
    """The profile's aggregates over a byte column."""
    return {
        "cov": _sum(b != 0),
        "match": _sum(mut_match(b, MATCH_INS5, subsets=True)),
        **{f"sub_{x}": _sum(mut_match(b, code)) for x, code in SUBSTITUTION.items()},
        "sub_N": _sum(mut_match(b, SUB_N, subsets=True)),
        "del": _sum(mut_match(b, DELET)),
        "ins": _sum(mut_match(b, INS_3, supersets=True)),
    }


def profile_by_pos(vec: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Coverage, matches, substitutions, deletions, insertions, info and rate per key and position.

    The rate of a position without information is null.
    """
    keys = keys or []
    counted = vec.groupBy(*keys, "pos").agg(*[c.alias(n) for n, c in counters(F.col("b")).items()])
    return counted.withColumn("info", F.col("match") + F.col("sub_N")).withColumn("sub_rate", F.try_divide(F.col("sub_N"), F.col("info")))


def count_by_pos(vec: DataFrame, query: int, subsets: bool = False, supersets: bool = False, keys: list[str] | None = None) -> DataFrame:
    return vec.groupBy(*(keys or []), "pos").agg(_sum(mut_match(F.col("b"), query, subsets, supersets)).alias("n"))


def count_by_read(vec: DataFrame, query: int = SUB_N, subsets: bool = True, supersets: bool = False, keys: list[str] | None = None) -> DataFrame:
    return vec.groupBy(*(keys or []), "read").agg(_sum(mut_match(F.col("b"), query, subsets, supersets)).alias("n"))


def sub_hist(vec: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Reads by their number of substitutions, 0 up to the largest found, empty bins included."""
    keys = keys or []
    found = count_by_read(vec, keys=keys).groupBy(*keys, F.col("n").alias("n_muts")).agg(F.count(F.lit(1)).alias("n_reads"))
    bins = found.groupBy(*keys).agg(F.max("n_muts").alias("_m")).select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), "_m")).alias("n_muts"))
    return bins.join(found, [*keys, "n_muts"], "left").select(*keys, "n_muts", F.coalesce("n_reads", F.lit(0).cast("long")).alias("n_reads"))


def min_cov(profile: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return profile.groupBy(*(keys or [])).agg(F.min("cov").alias("min_cov"))


def num_aligned(vec: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Reads per key: distinct within partial sums, whatever the number of positions."""
    return vec.select(*(keys or []), "read").distinct().groupBy(*(keys or [])).agg(F.count(F.lit(1)).alias("num_aligned"))


def cluster_rates(vec: DataFrame, membership: DataFrame, query: int = SUB_N, subsets: bool = True) -> DataFrame:
    """Mutation rate per cluster and position, reads weighted by membership (read, cluster, p).

    The denominator is the whole cluster's membership, covered or not, of the reads that have a vector.
    """
    mine = membership.join(vec.select("read").distinct(), "read", "left_semi")
    whole = mine.groupBy("cluster").agg(F.sum("p").alias("_w"))
    m = mut_match(F.col("b"), query, subsets).cast("double")
    top = vec.join(mine, "read").groupBy("cluster", "pos").agg(F.sum(F.col("p") * m).alias("_s"))
    return top.join(F.broadcast(whole), "cluster").select("cluster", "pos", F.try_divide("_s", "_w").alias("rate"))


def packed(profile: DataFrame, keys: list[str]) -> DataFrame:
    """Long profile to one row per key with arrays in order of position."""
    fields = [c for c in profile.columns if c not in (*keys, "pos")]
    rows = F.array_sort(F.collect_list(F.struct("pos", *fields)))
    one = profile.groupBy(*keys).agg(rows.alias("_r"))
    return one.select(*keys, *[F.col(f"_r.{f}").alias(f) for f in ("pos", *fields)])


def unpacked(rows: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Arrays to one row per 1-based position."""
    zipped = F.arrays_zip(*[F.col(f) for f in fields])
    return rows.select(*keys, F.posexplode(zipped).alias("_i", "_x")).select(*keys, (F.col("_i") + 1).alias("pos"), *[F.col(f"_x.{f}") for f in fields])


def array_profile(vectors: DataFrame, keys: list[str], end5: str = "end5") -> DataFrame:
    """The long profile from compact vectors (array<smallint> `vec`), a numpy sum per task.

    Each task sends one partial row per key and position, so the shuffle does not grow with reads.
    """
    import numpy as np
    import pandas as pd

    names = ["cov", "match", "sub_A", "sub_C", "sub_G", "sub_T", "sub_N", "del", "ins"]
    codes = np.arange(256)
    tables = {
        "cov": codes != 0,
        "match": (codes != 0) & ((codes | MATCH_INS5) == MATCH_INS5),
        **{f"sub_{x}": codes == c for x, c in SUBSTITUTION.items()},
        "sub_N": (codes != 0) & ((codes | SUB_N) == SUB_N),
        "del": codes == DELET,
        "ins": (codes & INS_3) == INS_3,
    }

    def partial(batches):
        for batch in batches:
            for key, rows in batch.groupby([*keys, end5], dropna=False):
                sums = np.zeros((len(names), rows["vec"].map(len).max()), np.int64)
                for v in rows["vec"]:
                    codes_ = np.asarray(v, np.int16) & 255
                    for k, n in enumerate(names):
                        sums[k, : len(codes_)] += tables[n][codes_]
                out = {k: v for k, v in zip([*keys], key)}
                frame = pd.DataFrame(dict(zip(names, sums)))
                frame.insert(0, "pos", key[-1] + np.arange(sums.shape[1]))
                for k in reversed(keys):
                    frame.insert(0, k, out[k])
                yield frame

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.select(*keys).schema)
    schema = (kinds + ", " if kinds else "") + "pos int, " + ", ".join(f"`{n}` long" for n in names)
    sums = vectors.select(*keys, end5, "vec").mapInPandas(partial, schema)
    total = sums.groupBy(*keys, "pos").agg(*[F.sum(n).alias(n) for n in names])
    return total.withColumn("info", F.col("match") + F.col("sub_N")).withColumn("sub_rate", F.try_divide("sub_N", "info"))
