"""Alignment records: filters, mates and their consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chemprobe.functions.bits import consensus, flag
from chemprobe.functions.codes import FLAGS, MIN_PHRED, PHRED_ENCODING, SUBSTITUTION, low_quality
from chemprobe.functions.sequences import cigar_consumed


def minimum_quality(phred: int = MIN_PHRED, encoding: int = PHRED_ENCODING) -> int:
    return phred + encoding


def compare_base(ref: Column, read: Column, good: Column) -> Column:
    """The byte of an aligned pair of bases: match or substitution if the call is good, else what it may be.

    A good call that is no base gives null: such a read is rejected.
    """
    code = F.create_map(*[x for b, c in SUBSTITUTION.items() for x in (F.lit(b), F.lit(c))])
    low = F.create_map(*[x for b in SUBSTITUTION for x in (F.lit(b), F.lit(low_quality(b)))])
    return F.when(~good, F.try_element_at(low, ref)).when(ref == read, F.lit(1)).otherwise(F.try_element_at(code, read))


def best_alignments(sam: DataFrame, keys: list[str]) -> DataFrame:
    """Records whose best score beats every other place's; of paired mates, both have to.

    Records: `keys` name a read (pair), as_score and xs_score, null where absent. A lone mate is judged alone.
    """
    ok = F.col("xs_score").isNull() | (F.col("xs_score") < F.coalesce(F.col("as_score"), F.lit(-(2**31))))
    judged = sam.groupBy(*keys).agg(F.bool_and(ok).alias("_ok"))
    return sam.join(judged.where("_ok").drop("_ok"), keys, "left_semi")


def overlapping(sam: DataFrame, sections: DataFrame) -> DataFrame:
    """Records with each section of their reference that they overlap.

    Equal references first, then the interval test; Spark broadcasts the sections when they are small
    enough and joins by reference otherwise.
    """
    end = F.col("pos") + cigar_consumed(F.col("cigar"), "M=XD") - 1
    s = sections.withColumnRenamed("ref", "_ref")
    on = (F.col("rname") == F.col("_ref")) & (F.col("pos") <= F.col("end3")) & (F.col("_end") >= F.col("end5"))
    return sam.withColumn("_end", end).join(s, on).drop("_ref", "_end")


def pairs(sam: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """One row per read name: structs mate1 and mate2 (null if absent) and `valid`.

    Mates must be paired, first and second, on one reference, facing each other. Lenient pairing accepts
    a lone mate; strict pairing rejects it.
    """
    fields = F.struct(*[F.col(c) for c in sam.columns if c not in keys])
    second = flag(F.col("flag"), FLAGS["paired"]) & flag(F.col("flag"), FLAGS["second"])
    grouped = sam.withColumn("_m", fields).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("flag", F.struct("pos", "flag")).alias("_any"),
        F.min_by(F.when(~second, F.col("_m")), F.when(~second, F.struct("pos", "flag"))).alias("mate1"),
        F.min_by(F.when(second, F.col("_m")), F.when(second, F.struct("pos", "flag"))).alias("mate2"),
    )
    a, b = F.col("mate1"), F.col("mate2")
    both = a.isNotNull() & b.isNotNull()
    agree = flag(a["flag"], FLAGS["paired"]) & flag(a["flag"], FLAGS["first"]) & (flag(a["flag"], FLAGS["rev"]) != flag(b["flag"], FLAGS["rev"]))
    lone = (F.col("n") == 1) & (F.lit(not strict) | ~flag(F.col("_any"), FLAGS["paired"]))
    valid = F.when(both, (F.col("n") == 2) & agree).otherwise(lone)
    return grouped.withColumn("valid", F.coalesce(valid, F.lit(False))).drop("_any")


def mate_consensus(first: DataFrame, second: DataFrame) -> DataFrame:
    """Long vectors (read, pos, b) of two mates as one; a position of one mate only keeps its byte."""
    a, b = first.withColumnRenamed("b", "_b1"), second.withColumnRenamed("b", "_b2")
    zero = F.lit(0)
    return a.join(b, ["read", "pos"], "full").select("read", "pos", consensus(F.coalesce("_b1", zero), F.coalesce("_b2", zero)).alias("b"))


def vector_consensus(first: Column, second: Column) -> Column:
    """The same over arrays; a null array counts as blank."""
    return F.when(first.isNull(), second).when(second.isNull(), first).otherwise(F.zip_with(first, second, consensus))


def covered(vec: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Long vectors without the reads that are blank everywhere."""
    some = vec.groupBy(*(keys or []), "read").agg(F.max("b").alias("_m")).where("_m > 0").drop("_m")
    return vec.join(some, [*(keys or []), "read"], "left_semi")


def consecutive_pairs(sam: DataFrame, order: str) -> DataFrame:
    """Records with the next one's flag when it has the same name, in file order."""
    w = Window.partitionBy("qname").orderBy(order)
    return sam.withColumn("next_flag", F.lead("flag").over(w))
