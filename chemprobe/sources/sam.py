"""Alignment records: SAM text in and out, BAM in."""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.runtime import FOLDERS, few

FIELDS = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
_NUMBERS = ("flag", "pos", "mapq", "pnext", "tlen")


def _checked(df: DataFrame) -> DataFrame:
    return df.where((F.length("seq") == F.length("qual")) & F.col("flag").between(0, 4095))


def parse_sam(lines: DataFrame) -> DataFrame:
    """Records of text lines (`value`): the eleven fields, as_score, xs_score. Headers and odd lines go."""
    parts = F.split("value", "\t")
    tag = lambda t: F.regexp_extract("value", rf"\t{t}:i:(-?\d+)(?:\t|$)", 1).try_cast("int")
    cols = [(parts[i].try_cast("int") if c in _NUMBERS else parts[i]).alias(c) for i, c in enumerate(FIELDS)]
    rows = lines.where(~F.col("value").startswith("@") & (F.size(parts) >= 11))
    return _checked(rows.select(*cols, tag("AS").alias("as_score"), tag("XS").alias("xs_score")))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    return parse_sam(spark.read.text(path))


def write_sam(sam: DataFrame, path: str) -> None:
    """Files in order of reference and position, each of one range of them; up to FOLDERS references have a folder each.

    Rows are dealt by ranges of (reference, position), so a reference that has nearly all reads is cut to many.
    """
    tags = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{t}:i:"), F.col(c))) for t, c in (("AS", "as_score"), ("XS", "xs_score")) if c in sam.columns]
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("0" if c in _NUMBERS else "*")) if c in sam.columns else F.lit("0" if c in _NUMBERS else "*") for c in FIELDS], *tags)
    dealt = sam.repartitionByRange("rname", "pos", F.xxhash64("qname")).sortWithinPartitions("rname", "pos")
    if few(sam.select("rname"), FOLDERS):
        dealt.select("rname", line.alias("value")).write.partitionBy("rname").text(path)
    else:
        dealt.select(line.alias("value")).write.text(path)


# The letters of packed bases and operations in a BAM record.
_BASES, _OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"


def bam_records(raw: bytes) -> Iterator[tuple]:
    """Records of a BAM file's bytes, in the order of FIELDS and then the AS and XS scores."""
    data = gzip.decompress(raw)  # blocked gzip is gzip members end to end
    if data[:4] != b"BAM\x01":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack_from("<i", data, 4)[0]
    names = []
    (n,) = struct.unpack_from("<i", data, at)
    at += 4
    for _ in range(n):
        (size,) = struct.unpack_from("<i", data, at)
        names.append(data[at + 4 : at + 3 + size].decode())
        at += 8 + size
    name_of = lambda i, same=None: "*" if i < 0 else ("=" if i == same else names[i])
    while at < len(data):
        size, ref, pos, l_name, mapq, _, n_ops, flag, l_seq, ref2, pos2, tlen = struct.unpack_from("<iiiBBHHHiiii", data, at)
        p = at + 36
        qname = data[p : p + l_name - 1].decode()
        p += l_name
        ops = struct.unpack_from(f"<{n_ops}I", data, p)
        p += 4 * n_ops
        half = data[p : p + (l_seq + 1) // 2]
        seq = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in half)[:l_seq]
        p += (l_seq + 1) // 2
        q = data[p : p + l_seq]
        p += l_seq
        scores = dict(_tags(data[p : at + 4 + size]))
        cigar = "".join(f"{o >> 4}{_OPS[o & 15]}" for o in ops) or "*"
        qual = "".join(chr(33 + x) for x in q) if l_seq and q[0] != 255 else "*"
        yield (qname, flag, name_of(ref), pos + 1, mapq, cigar, name_of(ref2, ref), pos2 + 1, tlen, seq or "*", qual, scores.get("AS"), scores.get("XS"))
        at += 4 + size


def _tags(data: bytes) -> Iterator[tuple[str, int]]:
    sizes = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
    at = 0
    while at + 3 <= len(data):
        tag, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in sizes:
            (value,) = struct.unpack_from("<" + sizes[kind], data, at)
            at += struct.calcsize(sizes[kind])
            if kind in "cCsSiI":
                yield tag, value
        elif kind in "ZH":
            at = data.index(0, at) + 1
        else:
            each = struct.calcsize(sizes[chr(data[at])])
            (n,) = struct.unpack_from("<i", data, at + 1)
            at += 5 + n * each


def read_bam(spark: SparkSession, path: str) -> DataFrame:
    """Records of BAM files, one task a file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                rows = pd.DataFrame(list(bam_records(bytes(raw))), columns=[*FIELDS, "as_score", "xs_score"])
                yield rows.astype({"as_score": "Int32", "xs_score": "Int32"})

    schema = ", ".join(f"{c} {'int' if c in _NUMBERS else 'string'}" for c in FIELDS) + ", as_score int, xs_score int"
    files = spark.read.format("binaryFile").load(path).select("content")
    return _checked(files.mapInPandas(run, schema))


def expected_missing(expected: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Work that still has to be done: what is expected and not there."""
    return expected.join(existing.select(*keys).distinct(), keys, "left_anti")
