"""Alignment records to vectors of relationship bytes, with positions made ambiguous by indels.

The walk along a CIGAR string and the search for equivalent placements are sequential per read, so they
run in numpy inside an Arrow function; everything around them (mates, sections, counters) is DataFrame
algebra.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemprobe.functions.codes import DELET, INS_3, INS_5, MATCH, SUB_N, SUBSTITUTION, low_quality
from chemprobe.operators.reads import minimum_quality, overlapping, pairs, vector_consensus

_STEP = re.compile(r"(\d+)([M=XDIS])")
#: An indel keeps this distance, in bases, from indels of the other kind when it is moved.
APART = 2

_CODE = np.zeros(256, np.uint8)
_LOW = np.zeros(256, np.uint8)
for _base, _bit in SUBSTITUTION.items():
    _CODE[ord(_base)], _LOW[ord(_base)] = _bit, low_quality(_base)


class ReadError(ValueError):
    """A record that cannot be turned into a vector."""


def steps(cigar: str) -> list[tuple[str, int]]:
    """The operations of a CIGAR string; ReadError for anything else in it."""
    found = [(op, int(n)) for n, op in _STEP.findall(cigar)]
    if not found or "".join(f"{n}{op}" for op, n in found) != cigar or any(n < 1 for _, n in found):
        raise ReadError(f"odd CIGAR {cigar!r}")
    return found


@dataclass
class Gap:
    """A run of bases that only one of the two sequences has: `at` there, `size` bases, `beside` in the other."""

    at: int
    size: int
    beside: int


@dataclass
class Walk:
    """What a record's CIGAR says within a section, in indexes of the section and the read from 0."""

    aligned: list[tuple[int, int, int, bool]] = field(default_factory=list)  # section, read, length, stated match
    deletions: list[Gap] = field(default_factory=list)
    insertions: list[Gap] = field(default_factory=list)


def walk(cigar: str, pos: int, read_length: int, end5: int, length: int) -> Walk:
    """Clips a record's operations to a section of `length` bases that begins at `end5`."""
    out, r, q = Walk(), pos - end5, 0
    for op, n in steps(cigar):
        lo, hi = max(r, 0), min(r + n, length)
        if op in "M=X":
            if lo < hi:
                out.aligned.append((lo, q + lo - r, hi - lo, op == "="))
            r, q = r + n, q + n
        elif op == "D":
            if lo < hi:
                out.deletions.append(Gap(lo, hi - lo, q))
            r += n
        else:
            if op == "I" and 0 < r < length:
                out.insertions.append(Gap(q, n, r))
            q += n
    if q != read_length:
        raise ReadError(f"CIGAR {cigar!r} takes {q} bases, the read has {read_length}")
    return out


class _Scene:
    """A section, a read and the vector that is being filled."""

    def __init__(self, ref: bytes, seq: bytes, qual: bytes, least: int):
        self.ref, self.seq = np.frombuffer(ref, np.uint8), np.frombuffer(seq, np.uint8)
        self.good = np.frombuffer(qual, np.uint8) >= least
        self.vec = np.zeros(len(ref), np.uint8)

    def relation(self, i: int, j: int) -> int:
        """The byte of section base i with read base j."""
        a, b = self.ref[i], self.seq[j]
        if not self.good[j]:
            return int(_LOW[a])
        if a == b:
            return MATCH
        if not _CODE[b]:
            raise ReadError("a good call that is no base")
        return int(_CODE[b])

    def fill(self, w: Walk) -> None:
        for i, j, n, stated in w.aligned:
            a, b, good = self.ref[i : i + n], self.seq[j : j + n], self.good[j : j + n]
            if not stated:
                bad = good & (a != b) & (_CODE[b] == 0)
                if bad.any():
                    raise ReadError("a good call that is no base")
                self.vec[i : i + n] = np.where(good, np.where(a == b, MATCH, _CODE[b]), _LOW[a])
            else:
                if (~good & (_LOW[b] == 0)).any():
                    raise ReadError("a stated match that is no base")
                self.vec[i : i + n] = np.where(good, MATCH, _LOW[b])
        for g in w.deletions:
            self.vec[g.at : g.at + g.size] = DELET
        for g in w.insertions:
            self.stamp(g.beside)

    def stamp(self, beside: int) -> None:
        """Marks both sides of an insertion before section base `beside`."""
        if 0 < beside <= len(self.vec):
            self.vec[beside - 1] |= INS_5
        if 0 <= beside < len(self.vec):
            self.vec[beside] |= INS_3

    def swapped(self, now: tuple[int, int], then: tuple[int, int]) -> int:
        """The relation of `now` if that of `then` may be the same one: a shared bit, or both substitutions."""
        a, b = self.relation(*now), self.relation(*then)
        return a if a & b or (a & SUB_N and b & SUB_N) else 0


def _slides(scene: _Scene, gap: Gap, others: list[Gap], fences: list[Gap], deletion: bool) -> None:
    """Marks every place that `gap` can slide to.

    One step takes the base next to the run into it and gives the base at its far end back, which the
    freed base of the other sequence then faces. Whole runs slide first; then, at each place that a run
    can take, its members part one by one from the side they move to. A run that is met is slid across
    as one with it. For one or two bases these are all equivalent placements; for longer runs those
    that split a run twice may be missing.
    """
    limit, facing = (len(scene.ref), len(scene.seq)) if deletion else (len(scene.seq), len(scene.ref))

    def free(step_to: int) -> bool:
        return all(min(abs(step_to - (f.beside - 1)), abs(step_to - f.beside)) >= APART for f in fences)

    def step(at: int, size: int, beside: int, way: int) -> tuple[int, int, int] | None:
        """The run one place on, or None. Runs that it meets are taken along."""
        a, n, b = at, size, beside
        for o in others:
            if way < 0 and o.at + o.size == a:
                a, n = o.at, n + o.size
            elif way > 0 and a + n == o.at:
                n += o.size
        into, back, faces = (a - 1, a + n - 1, b - 1) if way < 0 else (a + n, a, b)
        if not (0 <= into < limit and 0 <= faces < facing and free(into)):
            return None
        now, then = ((back, faces), (into, faces)) if deletion else ((faces, back), (faces, into))
        relation = scene.swapped(now, then)
        if not relation:
            return None
        if deletion:
            scene.vec[back] |= relation
            scene.vec[into] |= DELET
        else:
            scene.vec[faces] |= relation
            scene.stamp(b + way)
        return at + way, size, beside + way

    places = [(gap.at, gap.size, gap.beside)]
    for way in (1, -1):
        state = step(*places[0], way)
        while state:
            places.append(state)
            state = step(*state, way)
    if gap.size > 1:
        for (at, size, beside), way in product(places, (1, -1)):
            # members of the run on their own: each as far as the one before it, until one cannot move
            stop = None
            for k in range(size - 1, 0, -1) if way > 0 else range(size - 1):
                here, faces = at + k, beside
                while here + way != stop and (moved := step(here, 1, faces, way)):
                    here, _, faces = moved
                if here == at + k:
                    break
                stop = here


def vectorize_read(ref: str, seq: str, qual: str, cigar: str, pos: int, end5: int, least: int, ambiguous: bool = True) -> np.ndarray:
    """The vector (uint8) of one record over the section `ref`, which begins at the 1-based `end5`."""
    if len(seq) != len(qual):
        raise ReadError("bases and qualities differ in number")
    scene = _Scene(ref.encode(), seq.encode(), qual.encode(), least)
    w = walk(cigar, pos, len(seq), end5, len(ref))
    scene.fill(w)
    if ambiguous:
        for mine, fences, deletion in ((w.deletions, w.insertions, True), (w.insertions, w.deletions, False)):
            for g in mine:
                _slides(scene, g, [o for o in mine if o is not g], fences, deletion)
    return scene.vec


def _vectors(least: int, ambiguous: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vecs = []
            for row in zip(batch["section_seq"], batch["seq"], batch["qual"], batch["cigar"], batch["pos"], batch["end5"]):
                try:
                    vecs.append(vectorize_read(*row, least, ambiguous).astype(np.int16))
                except (ReadError, IndexError):
                    vecs.append(None)
            yield batch.drop(columns=["section_seq", "seq", "qual", "cigar", "pos"]).assign(vec=vecs)

    return run


def vectorize(sam: DataFrame, sections: DataFrame, least: int | None = None, ambiguous: bool = True, strict: bool = False) -> DataFrame:
    """Vectors of records: rname, section, end5, end3, read, vec (array<smallint>), error.

    sections: ref, section, end5, end3, section_seq. Mates are put together by their name; a record or
    pair that cannot be encoded, or covers nothing, has a null vector and an `error`.
    """
    least = minimum_quality() if least is None else least
    keys = ["rname", "section", "end5", "end3", "qname", "flag"]
    cut = overlapping(sam, sections.select("ref", "section", "end5", "end3", "section_seq")).select(*keys, "section_seq", "seq", "qual", "cigar", "pos")
    schema = "rname string, section string, end5 int, end3 int, qname string, flag int, vec array<smallint>"
    source = cut.select("rname", "section", F.col("end5").cast("int"), F.col("end3").cast("int"), "qname", F.col("flag").cast("int"), "section_seq", "seq", "qual", "cigar", "pos")
    found = source.mapInPandas(_vectors(least, ambiguous), schema).withColumn("pos", F.lit(0))
    paired = pairs(found, ["rname", "section", "end5", "end3", "qname"], strict)
    one, two = F.col("mate1"), F.col("mate2")
    failed = (one.isNotNull() & one["vec"].isNull()) | (two.isNotNull() & two["vec"].isNull())
    vec = vector_consensus(one["vec"].cast("array<int>"), two["vec"].cast("array<int>"))
    blank = ~F.exists(vec, lambda x: x != 0)
    error = F.when(~F.col("valid"), "mates").when(failed, "record").when(blank, "blank")
    return paired.select(
        "rname", "section", "end5", "end3", F.col("qname").alias("read"), F.when(error.isNull(), vec).cast("array<smallint>").alias("vec"), error.alias("error")
    )


def long_form(vectors: DataFrame, sections: DataFrame) -> DataFrame:
    """One row per read and position: rname, section, read, pos, base, b."""
    rows = vectors.where("vec IS NOT NULL").select("rname", "section", "end5", "read", F.posexplode("vec").alias("i", "b"))
    named = rows.join(sections.select(F.col("ref").alias("rname"), "section", "section_seq"), ["rname", "section"])
    return named.select("rname", "section", "read", (F.col("end5") + F.col("i")).alias("pos"), F.expr("substring(section_seq, i + 1, 1)").alias("base"), F.col("b").cast("int").alias("b"))
