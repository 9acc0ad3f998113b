"""Trimming and local alignment of reads, and per-position quality counts.

The aligner seeds by shared k-mers in one equi-join and extends with a banded local alignment; it scores
like a match-plus-one local aligner but promises no bit-identical placements.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the common start of the sequencing adapters.
ADAPTER = "AGATCGGAAGAGC"


@dataclass(frozen=True)
class TrimOptions:
    min_quality: int = 25
    encoding: int = 33
    adapter: str = ADAPTER
    overlap: int = 6
    error: float = 0.1
    min_length: int = 20
    discard_trimmed: bool = False
    discard_untrimmed: bool = False


@dataclass(frozen=True)
class AlignOptions:
    seed: int = 12
    match: int = 1
    mismatch: int = 1
    gap_open: int = 1
    gap_extend: int = 1
    min_score_rate: float = 0.5
    min_score_base: float = 1.0


def quality_cut(qual: np.ndarray, least: int) -> tuple[int, int]:
    """Where to cut so that the running sum of (quality - least) from either end is smallest there."""
    tail = np.cumsum((qual - least)[::-1])
    end = len(qual) - (int(tail.argmin()) + 1 if len(tail) and tail.min() < 0 else 0)
    head = np.cumsum(qual - least)
    start = int(head.argmin()) + 1 if len(head) and head.min() < 0 else 0
    return (start, end) if start < end else (0, 0)


def adapter_at(seq: str, adapter: str, overlap: int, error: float) -> int:
    """The first place from which the read agrees with the adapter's start, mismatches within `error`; or its length."""
    a, s = np.frombuffer(adapter.encode(), np.uint8), np.frombuffer(seq.encode(), np.uint8)
    whole = max(len(s) - len(a) + 1, 0)
    if whole:
        differ = sum((s[k : k + whole] != a[k]).astype(np.int32) for k in range(len(a)))
        hits = np.flatnonzero(differ <= int(error * len(a)))
        if len(hits):
            return int(hits[0])
    for i in range(whole, len(s) - overlap + 1):
        n = min(len(a), len(s) - i)
        if (s[i : i + n] != a[:n]).sum() <= int(error * n):
            return i
    return len(s)


def trim(reads: DataFrame, options: TrimOptions = TrimOptions()) -> DataFrame:
    """`reads` (read_id, mate, seq, qual, ...) cut by quality and adapter; pairs go with a mate that is too short."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seqs, quals, found = [], [], []
            for seq, qual in zip(batch["seq"], batch["qual"]):
                q = np.frombuffer(qual.encode(), np.uint8).astype(int) - options.encoding
                a, b = quality_cut(q, options.min_quality)
                seq, qual = seq[a:b], qual[a:b]
                k = adapter_at(seq, options.adapter, options.overlap, options.error)
                found.append(k < len(seq))
                seqs.append(seq[:k])
                quals.append(qual[:k])
            yield batch.assign(seq=seqs, qual=quals, _adapter=found)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reads.schema) + ", _adapter boolean"
    cut = reads.mapInPandas(run, schema)
    ok = F.length("seq") >= options.min_length
    if options.discard_trimmed:
        ok = ok & ~F.col("_adapter")
    if options.discard_untrimmed:
        ok = ok & F.col("_adapter")
    keys = [c for c in ("sample", "ref", "read_id") if c in reads.columns]
    whole = cut.groupBy(*keys).agg(F.bool_and(ok).alias("_ok")).where("_ok").drop("_ok")
    return cut.join(whole, keys, "left_semi").drop("_adapter")


def local_alignment(ref: str, seq: str, o: AlignOptions) -> tuple[int, int, str]:
    """(score, 1-based start, CIGAR with = and X and soft clips) of the best local alignment."""
    r, s = np.frombuffer(ref.encode(), np.uint8), np.frombuffer(seq.encode(), np.uint8)
    n, m = len(r), len(s)
    best = np.zeros((m + 1, n + 1), np.int32)
    up = np.full((m + 1, n + 1), -(10**6), np.int32)
    left = np.full((m + 1, n + 1), -(10**6), np.int32)
    cost = o.gap_open + o.gap_extend
    for i in range(1, m + 1):
        pair = np.where(r == s[i - 1], o.match, -o.mismatch)
        up[i, 1:] = np.maximum(best[i - 1, 1:] - cost, up[i - 1, 1:] - o.gap_extend)
        open_ = np.maximum(np.maximum(best[i - 1, :-1] + pair, up[i, 1:]), 0)
        # gaps along the reference: the best opening so far, less its length
        reach = np.maximum.accumulate(np.r_[0, open_] + o.gap_extend * np.arange(n + 1))
        left[i, 1:] = reach[:-1] - cost - o.gap_extend * (np.arange(1, n + 1) - 1)
        best[i, 1:] = np.maximum(open_, left[i, 1:])
    score = int(best.max())
    if score <= 0:
        return 0, 0, ""
    i, j = (int(v) for v in np.unravel_index(best.argmax(), best.shape))
    ops, tail = [], m - i
    while i > 0 and j > 0 and best[i, j] > 0:
        same = r[j - 1] == s[i - 1]
        if best[i, j] == best[i - 1, j - 1] + (o.match if same else -o.mismatch):
            ops.append("=" if same else "X")
            i, j = i - 1, j - 1
        elif best[i, j] == up[i, j]:
            while best[i, j] > 0:
                ops.append("I")
                opened = up[i, j] == best[i - 1, j] - cost
                i -= 1
                if opened:
                    break
        else:
            k = 1
            while j - k >= 0 and best[i, j] != best[i, j - k] - o.gap_open - o.gap_extend * k:
                k += 1
            ops += ["D"] * k
            j -= k
    ops += ["S"] * i
    ops = ["S"] * 0 + ops[::-1] + ["S"] * tail
    out, start = [], 0
    for k in range(1, len(ops) + 1):
        if k == len(ops) or ops[k] != ops[start]:
            out.append(f"{k - start}{ops[start]}")
            start = k
    return score, j + 1, "".join(out)


def align(reads: DataFrame, refs: DataFrame, options: AlignOptions = AlignOptions()) -> DataFrame:
    """Records of reads (read_id, mate, seq, qual) against refs (ref, seq), both strands.

    Columns: qname, flag, rname, pos, mapq, cigar, seq, qual, as_score, xs_score. Reads that share no
    seed with a reference, or score below the threshold, have no record.
    """
    k = options.seed
    kmers = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - k + 1, F.lit(1))), lambda i: F.substring(F.col(c), i, F.lit(k))))
    turned = F.expr("translate(reverse(seq), 'ACGT', 'TGCA')")
    both = reads.select("read_id", "mate", F.explode(F.array(F.struct(F.lit(False).alias("rev"), F.col("seq").alias("s"), F.col("qual").alias("q")), F.struct(F.lit(True).alias("rev"), turned.alias("s"), F.reverse("qual").alias("q")))).alias("x")).select("read_id", "mate", "x.*")
    seeds = refs.select(F.col("ref"), F.explode(kmers("seq")).alias("w"))
    hits = both.where(F.length("s") >= k).select("read_id", "mate", "rev", "s", "q", F.explode(kmers("s")).alias("w")).join(seeds, "w")
    near = hits.select("read_id", "mate", "rev", "s", "q", "ref").distinct().join(refs.select("ref", F.col("seq").alias("r")), "ref")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [local_alignment(r, s, options) for r, s in zip(batch["r"], batch["s"])]
            yield batch.drop(columns=["r"]).assign(score=[x[0] for x in rows], pos=[x[1] for x in rows], cigar=[x[2] for x in rows])

    schema = "ref string, read_id string, mate int, rev boolean, s string, q string, score int, pos int, cigar string"
    found = near.select("ref", F.col("read_id").cast("string"), F.col("mate").cast("int"), "rev", "s", "q", "r").mapInPandas(run, schema)
    found = found.where(F.col("score") >= options.min_score_base + options.min_score_rate * F.length("s"))
    top = found.groupBy("read_id", "mate").agg(F.max_by(F.struct("ref", "rev", "s", "q", "pos", "cigar", "score"), F.struct("score", F.col("ref"), F.col("rev"))).alias("b"), F.sort_array(F.collect_list("score"), False).alias("all"))
    other = F.try_element_at("all", F.lit(2))
    mates = F.when(F.col("mate") == 0, 0).otherwise(F.when(F.col("mate") == 1, 65).otherwise(129))
    mapq = F.when(other.isNull(), 42).when(other == F.col("b.score"), 1).otherwise(F.least(F.lit(40), (F.col("b.score") - other) * 2 + 2)).cast("int")
    return top.select(
        F.col("read_id").alias("qname"), (mates + F.when(F.col("b.rev"), 16).otherwise(0)).alias("flag"), F.col("b.ref").alias("rname"), F.col("b.pos").alias("pos"),
        mapq.alias("mapq"), F.col("b.cigar").alias("cigar"), F.col("b.s").alias("seq"), F.col("b.q").alias("qual"), F.col("b.score").alias("as_score"), other.alias("xs_score"),
    )


def quality_report(reads: DataFrame, encoding: int = 33) -> DataFrame:
    """Per mate and position: reads, mean quality and base counts."""
    zipped = F.arrays_zip(F.split("seq", "").alias("b"), F.split("qual", "").alias("q"))
    rows = reads.where(F.length("seq") > 0).select("mate", F.posexplode(zipped).alias("i", "x")).select("mate", (F.col("i") + 1).alias("pos"), "x.b", (F.ascii("x.q") - encoding).alias("q"))
    return rows.groupBy("mate", "pos").agg(F.count(F.lit(1)).alias("n"), F.avg("q").alias("mean_quality"), *[F.count(F.when(F.col("b") == b, 1)).alias(f"n_{b}") for b in "ACGTN"])
