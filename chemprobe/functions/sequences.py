"""Columns over nucleic sequences, CIGAR strings and read names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_dna(s: Column) -> Column:
    return s.rlike(r"\A[ACGT]+\z")


def is_rna(s: Column) -> Column:
    return s.rlike(r"\A[ACGU]+\z")


def reverse_complement(s: Column) -> Column:
    """Other letters than ACGT stay as they are."""
    return F.translate(F.reverse(s), "ACGT", "TGCA")


def transcribe(s: Column) -> Column:
    return F.translate(s, "T", "U")


def reverse_transcribe(s: Column) -> Column:
    return F.translate(s, "U", "T")


def hamming(a: Column, b: Column) -> Column:
    """Differing positions of two strings of equal length; null otherwise."""
    differ = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(differ, F.lit(0), lambda s, x: s + x))


def diff_positions(a: Column, b: Column) -> Column:
    """1-based positions at which two strings of equal length differ; null otherwise."""
    placed = F.transform(F.split(a, ""), lambda x, i: F.struct(x.alias("x"), (i + 1).alias("i")))
    at = F.filter(F.zip_with(placed, F.split(b, ""), lambda p, y: F.when(p["x"] != y, p["i"])), lambda i: i.isNotNull())
    return F.when(F.length(a) == 0, F.array().cast("array<int>")).when(F.length(a) == F.length(b), at)


def found_within(s: Column, pattern: str, lo: int, hi: int, mismatches: int = 0) -> Column:
    """Whether `pattern` lies in the 1-based closed region [lo, hi] of `s` with at most so many mismatches."""
    n = len(pattern)
    region = F.substring(s, lo, max(hi - lo + 1, 0))
    if mismatches == 0:
        return F.instr(region, pattern) > 0
    if hi - lo + 1 < n:
        return F.lit(False)
    starts = F.sequence(F.lit(1), F.greatest(F.length(region) - n + 1, F.lit(1)))
    near = lambda i: hamming(F.substring(region, i, F.lit(n)), F.lit(pattern)) <= mismatches
    return (F.length(region) >= n) & F.exists(starts, lambda i: F.coalesce(near(i), F.lit(False)))


def locate_primer(s: Column, primer: Column) -> Column:
    """(pos5, pos3), 1-based and closed, of a primer's only occurrence; null if there is none or more."""
    once = F.size(F.split(s, F.concat(F.lit("\\Q"), primer, F.lit("\\E")), -1)) == 2
    at = F.instr(s, primer)
    return F.when(once, F.struct(at.alias("pos5"), (at + F.length(primer) - 1).alias("pos3")))


def column_base(name: Column) -> Column:
    """The base in a position column's name such as `C36`; empty if it is no such name."""
    return F.regexp_extract(name, "^([ACGT])([0-9]+)$", 1)


def column_position(name: Column) -> Column:
    return F.regexp_extract(name, "^([ACGT])([0-9]+)$", 2).try_cast("int")


def illumina_key(read_id: Column) -> Column:
    """Lane position of a read name: fields 5 to 7 of its first word's colon-parted fields."""
    fields = F.split(F.split(read_id, r"\s")[0], ":")
    return F.when(F.size(fields) >= 7, F.concat_ws(":", F.slice(fields, 5, 3)))


_OPERATION = r"(\d+)([M=XDIS])"


def cigar_valid(cigar: Column) -> Column:
    return cigar.rlike(r"^(?:[1-9]\d*[M=XDIS])+$")


def cigar_operations(cigar: Column) -> Column:
    """An array of (op, length)."""
    lengths, ops = F.regexp_extract_all(cigar, F.lit(_OPERATION), F.lit(1)), F.regexp_extract_all(cigar, F.lit(_OPERATION), F.lit(2))
    return F.transform(F.arrays_zip(ops.alias("o"), lengths.alias("n")), lambda x: F.struct(x["o"].alias("op"), x["n"].cast("int").alias("length")))


def cigar_consumed(cigar: Column, ops: str) -> Column:
    """Total length of the operations named in `ops`; `M=XD` consume the reference, `M=XIS` the read."""
    mine = F.filter(cigar_operations(cigar), lambda x: x["op"].isin(list(ops)))
    return F.aggregate(mine, F.lit(0), lambda s, x: s + x["length"])
