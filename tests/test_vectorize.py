"""Vectors of reads against an enumeration of all equivalent placements of an indel."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chemprobe.functions.codes import low_quality
from chemprobe.operators.vectorize import ReadError, steps, vectorize, vectorize_read

Q = 58


def placements(ref, read, k, deleted):
    """The bytes of a read without substitutions: an OR over all ways to leave out k bases."""
    long, short = (ref, read) if deleted else (read, ref)
    v = np.zeros(len(ref), int)
    for out in itertools.combinations(range(len(long)), k):
        if "".join(c for i, c in enumerate(long) if i not in out) == short:
            if deleted:
                v |= np.array([2 if i in out else 1 for i in range(len(ref))])
            else:
                v |= 1
                at = 0
                for j in range(len(read)):
                    if j not in out:
                        at += 1
                        continue
                    if at > 0:
                        v[at - 1] |= 4
                    if at < len(ref):
                        v[at] |= 8
    return v


@pytest.mark.parametrize("k", [1, 2])
@pytest.mark.parametrize("deleted", [True, False])
def test_ambiguous_indels(k, deleted):
    rng = random.Random(k)
    for t in range(400):
        ref = "".join(rng.choice("AC" if t % 2 else "ACGT") for _ in range(12))
        p = rng.randrange(1, len(ref) - k)
        read = ref[:p] + ref[p + k :] if deleted else ref[:p] + "".join(rng.choice("ACGT") for _ in range(k)) + ref[p:]
        cigar = f"{p}={k}D{len(ref) - p - k}=" if deleted else f"{p}={k}I{len(ref) - p}="
        got = vectorize_read(ref, read, "I" * len(read), cigar, 1, 1, Q)
        assert (got == placements(ref, read, k, deleted)).all(), (ref, read, cigar)


def test_bases_and_quality():
    v = vectorize_read("ACGT", "ACTT", "II!I", "4M", 1, 1, Q)
    assert v.tolist() == [1, 1, low_quality("G"), 1]
    assert vectorize_read("ACGT", "AATT", "IIII", "4M", 1, 1, Q).tolist() == [1, 16, 128, 1]
    assert vectorize_read("ACGT", "ANGT", "I!II", "4M", 1, 1, Q).tolist() == [1, low_quality("C"), 1, 1]
    with pytest.raises(ReadError):
        vectorize_read("ACGT", "ANGT", "IIII", "4M", 1, 1, Q)


def test_clipping_to_the_section():
    read = "GGACGTCC"
    assert vectorize_read("CGT", read, "I" * 8, "2S4=2S", 5, 6, Q).tolist() == [1, 1, 1]
    assert vectorize_read("TTTT", read, "I" * 8, "8M", 1, 100, Q).tolist() == [0, 0, 0, 0]
    assert vectorize_read("ACGTAA", "ACGT", "IIII", "4M", 3, 1, Q, False).tolist()[:2] == [0, 0]


@pytest.mark.parametrize("cigar", ["", "4", "M4", "4M1H", "0M", "3M", "5M"])
def test_odd_cigars(cigar):
    with pytest.raises(ReadError):
        vectorize_read("ACGT", "ACGT", "IIII", cigar, 1, 1, Q)


def test_steps():
    assert steps("3S10=1X2D4I5M") == [("S", 3), ("=", 10), ("X", 1), ("D", 2), ("I", 4), ("M", 5)]


def test_mates_and_errors(spark):
    ref = "ACGTACGTAC"
    rows = [
        ("p", 65, "r", 1, "6M", "ACGTAC", "IIIIII"), ("p", 145, "r", 5, "6M", "ACGGAC", "IIIIII"),
        ("lone", 65, "r", 1, "4M", "ACGA", "IIII"), ("same", 65, "r", 1, "4M", "ACGT", "IIII"), ("same", 129, "r", 1, "4M", "ACGT", "IIII"),
        ("bad", 0, "r", 1, "5M", "ACGT", "IIII"), ("away", 0, "r", 40, "4M", "ACGT", "IIII"),
    ]
    sam = spark.createDataFrame(rows, "qname string, flag int, rname string, pos int, cigar string, seq string, qual string")
    sections = spark.createDataFrame([("r", "full", 1, 10, ref)], "ref string, section string, end5 int, end3 int, section_seq string")
    got = {r["read"]: (r["vec"], r["error"]) for r in vectorize(sam, sections).collect()}
    assert got["p"] == ([1, 1, 1, 1, 1, 1, 1, 64, 1, 1], None)
    assert got["lone"] == ([1, 1, 1, 16, 0, 0, 0, 0, 0, 0], None)
    assert got["same"] == (None, "mates") and got["bad"] == (None, "record") and "away" not in got
    strict = {r["read"]: r["error"] for r in vectorize(sam, sections, strict=True).collect()}
    assert strict["lone"] == "mates"
    assert vectorize(sam.limit(0), sections).count() == 0
    assert vectorize(sam, sections).where(F.col("error").isNull()).count() == 2
