"""Filters and counters before clustering, in this order: bases, outlying reads, weak positions,
close mutations, unique patterns. Long vectors: read, pos, base, b."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chemprobe.functions.bits import mut_match
from chemprobe.functions.codes import INDEL, MATCH, MATCH_INS5, SUB_N


def mutated(include_del: bool = False) -> Column:
    return mut_match(F.col("b"), SUB_N | INDEL if include_del else SUB_N, subsets=True)


def keep_bases(vec: DataFrame, include_gu: bool = False) -> DataFrame:
    """Positions whose reference base is A or C, unless all are wanted."""
    return vec if include_gu else vec.where(F.col("base").isin("A", "C"))


def outlying_reads(vec: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Reads with more substitutions and indels than the mean and `sigmas` sample deviations.

    With one read there is no deviation, and none is dropped.
    """
    per = vec.groupBy("read").agg(F.sum(mut_match(F.col("b"), SUB_N | INDEL, subsets=True).cast("long")).alias("n"))
    limit = per.agg((F.avg("n") + sigmas * F.stddev_samp("n")).alias("limit"))
    return per.join(F.broadcast(limit)).where(F.col("n") > F.col("limit")).select("read", "n")


def weak_positions(vec: DataFrame, threshold: float = 0.005, include_del: bool = False) -> DataFrame:
    """Positions whose mutated share of mutated and matching reads is below `threshold`; those without either stay."""
    match = F.sum(((F.col("b") == MATCH) | (F.col("b") == MATCH_INS5)).cast("long"))
    per = vec.groupBy("pos").agg(match.alias("m"), F.sum(mutated(include_del).cast("long")).alias("x"))
    return per.where(F.try_divide(F.col("x"), F.col("x") + F.col("m")) < threshold).select("pos")


def crowded_reads(vec: DataFrame, least: int = 4, include_del: bool = False) -> DataFrame:
    """Reads with two mutations less than `least` positions apart."""
    w = Window.partitionBy("read").orderBy("pos")
    hits = vec.where(mutated(include_del)).select("read", "pos", (F.col("pos") - F.lag("pos").over(w)).alias("gap"))
    return hits.where(F.col("gap") < least).select("read").distinct()


def unique_patterns(vec: DataFrame, include_del: bool = False) -> DataFrame:
    """Reads by their 0/1 pattern over the positions in order: pattern, n, first_read."""
    bit = F.when(mutated(include_del), "1").otherwise("0")
    cells = F.array_sort(F.collect_list(F.struct("pos", bit.alias("x"))))
    per = vec.groupBy("read").agg(F.array_join(F.transform(cells, lambda c: c["x"]), "").alias("pattern"))
    return per.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.min("read").alias("first_read"))


def preprocess(vec: DataFrame, include_gu: bool = False, include_del: bool = False, threshold: float = 0.005, least: int = 4) -> DataFrame:
    """The vectors that clustering uses."""
    bases = keep_bases(vec, include_gu)
    calm = bases.join(outlying_reads(bases), "read", "left_anti")
    strong = calm.join(weak_positions(calm, threshold, include_del), "pos", "left_anti")
    return strong.join(crowded_reads(strong, least, include_del), "read", "left_anti")


def report(vec: DataFrame, include_gu: bool = False, include_del: bool = False, threshold: float = 0.005, least: int = 4) -> DataFrame:
    """Counters of the steps as rows (step, n)."""
    bases = keep_bases(vec, include_gu)
    outlying = outlying_reads(bases)
    calm = bases.join(outlying, "read", "left_anti")
    weak = weak_positions(calm, threshold, include_del)
    strong = calm.join(weak, "pos", "left_anti")
    crowded = crowded_reads(strong, least, include_del)
    used = strong.join(crowded, "read", "left_anti")
    count = lambda df, step, col: df.agg(F.countDistinct(col).alias("n")).select(F.lit(step).alias("step"), "n")
    steps = [
        count(vec, "reads", "read"), count(vec, "positions", "pos"), count(bases, "positions_ac", "pos"), count(outlying, "reads_outlying", "read"),
        count(weak, "positions_weak", "pos"), count(crowded, "reads_crowded", "read"), count(used, "reads_used", "read"), count(used, "positions_used", "pos"),
    ]
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


def enough_reads(used: DataFrame, least: int = 1000) -> int:
    """The number of reads used; ValueError if there are fewer than `least`."""
    n = used.select("read").distinct().count()
    if n < least:
        raise ValueError(f"{n} reads are left, {least} are needed")
    return n


def report_text(counters: DataFrame) -> str:
    """The report as lines of `step: n`; its rows are the steps, a fixed few."""
    return "".join(f"{r['step'].replace('_', ' ')}: {r['n']}\n" for r in counters.collect())
