"""Sections: 1-based closed intervals of a reference, from coordinates, primers or the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemprobe.functions.sequences import locate_primer, reverse_complement

PRIMER_GAP = 2


def sections(refs: DataFrame, specs: DataFrame, gap: int = PRIMER_GAP) -> DataFrame:
    """Sections of `refs` (ref, seq) as `specs` (ref, end5, end3, fwd, rev, section; all but ref may be null) ask.

    Negative coordinates count from the 3' end. Without a coordinate, a section begins `gap` bases after
    its forward primer and ends as far before its reverse primer's site, or takes the reference's end.
    References without a spec get one section, `full`. A primer that is not found once, or an interval
    outside the reference, gives `valid` false.
    """
    gap = max(gap, 0)
    own = refs.join(specs, "ref", "left")
    n = F.length("seq")
    real = lambda c: F.when(F.col(c) < 0, F.col(c) + n + 1).otherwise(F.col(c))
    fwd, rev = locate_primer(F.col("seq"), F.col("fwd")), locate_primer(F.col("seq"), reverse_complement(F.col("rev")))
    lost = (F.col("end5").isNull() & F.col("fwd").isNotNull() & fwd.isNull()) | (F.col("end3").isNull() & F.col("rev").isNotNull() & rev.isNull())
    out = own.select(
        "ref", "seq", "section", n.alias("length"), lost.alias("_lost"),
        F.coalesce(real("end5"), fwd["pos3"] + gap + 1, F.lit(1)).cast("int").alias("end5"),
        F.coalesce(real("end3"), rev["pos5"] - gap - 1, n).cast("int").alias("end3"),
    )
    valid = ~F.col("_lost") & (F.col("end5") >= 1) & (F.col("end5") <= F.col("end3")) & (F.col("end3") <= F.col("length"))
    whole = (F.col("end5") == 1) & (F.col("end3") == F.col("length"))
    name = F.coalesce("section", F.when(whole, F.lit("full")).otherwise(F.concat_ws("-", "end5", "end3")))
    out = out.withColumn("valid", valid).withColumn("section", name).withColumn("is_full", whole)
    part = F.when(F.col("valid"), F.expr("substring(seq, end5, end3 - end5 + 1)"))
    return out.withColumn("section_seq", part).drop("_lost", "seq").dropDuplicates(["ref", "end5", "end3"])


def subsequence(vec: DataFrame, end5: int, end3: int) -> DataFrame:
    """Positions of long vectors within a closed interval: reaches the scan as a pushed filter."""
    if not 1 <= end5 <= end3:
        raise ValueError(f"{end5}-{end3} is no interval")
    return vec.where(F.col("pos").between(end5, end3))


def without_sections(refs: DataFrame, found: DataFrame) -> DataFrame:
    return refs.join(found, "ref", "left_anti")
