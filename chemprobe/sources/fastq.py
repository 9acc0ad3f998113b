"""FASTQ in and out, and the finding of FASTQ files."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: File name endings and the mate that they tell; the longest that fits counts.
EXTENSIONS = [f"{e}{z}" for e in (".fq", ".fastq") for z in ("", ".gz")]
_MATE = re.compile(r"^(?P<ref>.+?)(?:[_.-](?:R|mate)?(?P<mate>[12])(?:_001)?)?$", re.I)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The lines of a batch (file, block, value) by the block of a file that they are in."""
    names, starts = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    code = names.indices.to_numpy()
    cuts = np.flatnonzero((code[1:] != code[:-1]) | (starts[1:] != starts[:-1])) + 1
    for lo, hi in pairwise([0, *cuts.tolist(), len(code)]):
        if lo < hi:
            yield (names.dictionary[int(code[lo])].as_py(), int(starts[lo])), batch.column(2).slice(lo, hi - lo)


def _begins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, n, first): of every block its number of lines and the first three."""
    now, n, first = None, 0, []
    out = lambda: pa.RecordBatch.from_pylist([{"file": now[0], "block": now[1], "n": n, "first": first}], _BEGINS)
    for batch in batches:
        for at, lines in _runs(batch):
            if at != now:
                if now:
                    yield out()
                now, n, first = at, 0, []
            n, first = n + len(lines), first + lines[: 3 - len(first)].to_pylist()
    if now:
        yield out()


_BEGINS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("first", pa.list_(pa.string()))])


def _records(known: Callable[[], dict]) -> Callable:
    """Fours of lines: each block has the records that begin in it, and their last lines from the blocks after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, now, rec, skip, kept = known(), None, 0, 0, None

        def out(lines: pa.Array) -> pa.RecordBatch:
            n = len(lines) // 4
            head, seq, qual = (lines.take(pa.array(np.arange(n) * 4 + k)) for k in (0, 1, 3))
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * n, lines.type), pa.array(rec + np.arange(n)), head, seq, qual], ["file", "rec", "head", "seq", "qual"])

        def last() -> Iterator[pa.RecordBatch]:
            if now and kept is not None and len(kept):
                lines = kept.to_pylist()
                lines += blocks.get(now, (0, []))[1][: 4 - len(lines)]
                lines += [""] * (len(lines) == 3)  # the file ends with an empty line of qualities
                yield out(pa.array(lines[: len(lines) // 4 * 4], kept.type))

        for batch in batches:
            for at, lines in _runs(batch):
                if at != now:
                    yield from last()
                    now, before = at, blocks.get(at, (0, []))[0]
                    rec, skip, kept = -(-before // 4), -before % 4, None
                if skip:
                    lines, skip = lines.slice(skip), max(skip - len(lines), 0)
                lines = lines if kept is None else pa.concat_arrays([kept, lines])
                whole = len(lines) // 4 * 4
                if whole:
                    yield out(lines.slice(0, whole))
                rec, kept = rec + whole // 4, lines.slice(whole)
        yield from last()

    return run


def read_fastq(spark: SparkSession, path: str, interleaved: bool = False) -> DataFrame:
    """(file, rec, read_id, mate, seq, qual): one row per four lines, numbered within the file.

    A record cannot be told from its middle, so the lines of each block of a file are counted first; then all blocks
    are read at once, line by line. The driver holds three lines of each block of files that have several. A
    truncated last record is left out, and records whose bases and qualities differ in number are too.
    """
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    blocks = lines.mapInArrow(_begins, "file string, block long, n long, first array<string>")
    file = Window.partitionBy("file").orderBy("block")
    tail = F.slice(F.flatten(F.collect_list("first").over(file.rowsBetween(1, 3))), 1, 3)
    blocks = blocks.select("file", "block", (F.sum("n").over(file) - F.col("n")).alias("before"), tail.alias("tail"), F.count(F.lit(1)).over(Window.partitionBy("file")).alias("k"))
    known = spark.sparkContext.broadcast({(r["file"], r["block"]): (r["before"], r["tail"]) for r in blocks.where("k > 1").collect()})
    rows = lines.mapInArrow(_records(lambda: known.value), "file string, rec long, head string, seq string, qual string")
    name = F.element_at(F.split("file", "/"), -1)
    by_name = F.coalesce(F.expr(r"try_cast(nullif(regexp_extract(element_at(split(file, '/'), -1), '[_.-](?:R|mate)?([12])(?:_001)?\\.f(?:ast)?q', 1), '') AS INT)"), F.lit(0))
    mate = (F.col("rec") % 2 + 1).cast("int") if interleaved else by_name
    good = rows.where((F.length("seq") == F.length("qual")) & F.col("head").startswith("@"))
    return good.select(name.alias("file"), F.col("rec").cast("int").alias("rec"), F.regexp_extract("head", r"^@(\S+)", 1).alias("read_id"), mate.alias("mate"), "seq", "qual")


def write_demultiplexed(reads: DataFrame, path: str, least: int = 2) -> None:
    """Reads (ref, mate, read_id, seq, qual) as FASTQ text by reference and mate; references with few reads are left out.

    Each reference is a folder, so their names are few enough to be broadcast; a reference that has nearly all reads
    is written by the tasks that hold them.
    """
    many = reads.groupBy("ref").agg(F.countDistinct("read_id").alias("n")).where(F.col("n") >= least).select("ref")
    text = F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual")
    reads.join(F.broadcast(many), "ref", "left_semi").select("ref", "mate", text.alias("value")).write.partitionBy("ref", "mate").text(path)


def find_units(spark: SparkSession, paths: list[str], kind: str = "paired") -> DataFrame:
    """(ref, kind, file1, file2) of FASTQ files in files and folders; a mate without its partner is left out.

    The listing is the driver's; mates meet in a full outer join by name.
    """
    files = [os.path.join(p, f) for p in paths for f in (sorted(os.listdir(p)) if os.path.isdir(p) else [""])]
    rows = []
    for f in (x.rstrip("/") for x in files):
        ext = next((e for e in sorted(EXTENSIONS, key=len, reverse=True) if f.endswith(e)), None)
        if ext:
            m = _MATE.match(os.path.basename(f)[: -len(ext)])
            rows.append((m["ref"], int(m["mate"] or 0), f))
    df = spark.createDataFrame(rows, "ref string, mate int, file string")
    if kind != "paired":
        return df.where("mate = 0").select("ref", F.lit(kind).alias("kind"), F.col("file").alias("file1"), F.lit(None).cast("string").alias("file2"))
    a, b = df.where("mate = 1").select("ref", F.col("file").alias("file1")), df.where("mate = 2").select("ref", F.col("file").alias("file2"))
    return a.join(b, "ref", "full").where("file1 IS NOT NULL AND file2 IS NOT NULL").select("ref", F.lit("paired").alias("kind"), "file1", "file2")


def unmatched_ids(first: DataFrame, second: DataFrame) -> DataFrame:
    """Read names of one mate's file that the other lacks."""
    return first.select("read_id").join(second.select("read_id"), "read_id", "left_anti")
