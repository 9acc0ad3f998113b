"""Mutation vectors in ORC batches of one column per position, and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.functions.bits import unsigned
from chemprobe.runtime import FOLDERS, few

INDEX = "__index_level_0__"


def batch_rows(length: int, megabytes: float = 32.0) -> int:
    """Vectors of a batch of so many MiB of base calls; one at least."""
    return max(1, round(megabytes * 2**20) // max(length, 1))


def write_vectors(vectors: DataFrame, path: str, length: int, megabytes: float = 32.0, sections: DataFrame | None = None) -> None:
    """Compact vectors (rname, section, end5, end3, read, vec) as ORC, in folders by reference and section.

    Each task writes its own files, so a reference that has nearly all reads is written by all tasks. Over FOLDERS
    sections have no folders; their rows are in order of reference and section, so that a reader of one skips the
    rest. `sections` (ref, section): all that vectors may have, else they are counted from the vectors.
    """
    out = vectors.where("vec IS NOT NULL").sortWithinPartitions("rname", "section")
    out = out.select(*[c for c in out.columns if c not in ("rname", "section")], "rname", "section")
    named = out.select("rname", "section") if sections is None else sections.select("ref", "section")
    writer = out.write.option("maxRecordsPerFile", batch_rows(length, megabytes))
    (writer.partitionBy("rname", "section") if few(named, FOLDERS) else writer).orc(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_wide_vectors(spark: SparkSession, path: str, positions: list[int] | None = None) -> DataFrame:
    """Long vectors (read, pos, base, b) of batches with one byte column per position, such as `C36`.

    Only the asked columns are read. Bytes are signed in the files and 0 to 255 here.
    """
    wide = spark.read.orc(path)
    places = {}
    for c in wide.columns:
        if c != INDEX:
            if not (c[:1] in "ACGT" and c[1:].isdigit()):
                raise ValueError(f"no position column: {c}")
            places[c] = int(c[1:])
    wanted = [c for c, p in places.items() if positions is None or p in positions]
    read = F.col(INDEX)
    if dict(wide.dtypes)[INDEX] == "binary":
        read = F.decode(read, "UTF-8")
    long = wide.select(read.alias("read"), *wanted).unpivot(["read"], wanted, "name", "v")
    return long.select("read", F.expr("cast(substring(name, 2) as int)").alias("pos"), F.expr("substring(name, 1, 1)").alias("base"), unsigned(F.col("v")).alias("b"))


def report(vectors: DataFrame, began: str, ended: str, checksums: list[str]) -> DataFrame:
    """One row of text fields about a run: counts, shares, speed, as they are stored."""
    took = (F.unix_micros(F.to_timestamp(F.lit(ended), "yyyy-MM-dd HH:mm:ss.SSSSSS")) - F.unix_micros(F.to_timestamp(F.lit(began), "yyyy-MM-dd HH:mm:ss.SSSSSS"))) / 1e6
    n = vectors.agg(F.count(F.when(F.col("error").isNull(), 1)).alias("ok"), F.count("error").alias("bad"))
    cols = {
        "Reads Vectorized": F.col("ok"), "Reads with Errors": F.col("bad"), "Fraction Vectorized": F.round(F.try_divide(F.col("ok"), F.col("ok") + F.col("bad")), 6),
        "Batches": F.lit(len(checksums)), "Checksums": F.lit(", ".join(checksums)), "Began": F.lit(began), "Ended": F.lit(ended),
        "Time Taken": took, "Speed": F.round(F.try_divide(F.col("ok"), took), 1),
    }
    return n.select(*[c.cast("string").alias(k) for k, c in cols.items()])


def bad_batches(spark: SparkSession, path: str, checksums: list[str]) -> DataFrame:
    """(checksum, problem) of listed batches that no file has, and of files that are not listed."""
    files = spark.read.format("binaryFile").load(path).select(F.md5("content").alias("checksum"))
    listed = spark.createDataFrame([(c,) for c in checksums], "checksum string")
    lost = listed.join(files, "checksum", "left_anti").withColumn("problem", F.lit("missing"))
    return lost.unionByName(files.join(listed, "checksum", "left_anti").withColumn("problem", F.lit("not listed")))
