"""FASTA in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chemprobe.functions.sequences import is_dna


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(ref, seq, length) of FASTA files; split where a line begins with `>`, so that long files are read in parallel.

    A name is a header's first word; the first record of a name wins, in order of file and place. Blank
    names and sequences that are not ACGT are left out.
    """
    raw = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"\A>", "").alias("value"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    head, body = F.split("value", "\n", 2)[0], F.get(F.split("value", "\n", 2), F.lit(1))
    rows = raw.select("file", "at", F.regexp_extract(head, r"^(\S*)", 1).alias("ref"), F.regexp_replace(F.coalesce(body, F.lit("")), r"\s", "").alias("seq"))
    good = rows.where((F.col("ref") != "") & is_dna(F.col("seq")))
    first = Window.partitionBy("ref").orderBy("file", "at")
    return good.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("ref", "seq", F.length("seq").alias("length"))


def write_fasta(refs: DataFrame, path: str) -> None:
    """Writes (ref, seq); an existing path, a blank name or a repeated one is an error."""
    bad = refs.groupBy("ref").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR ref IS NULL OR trim(ref) = ''").limit(3).collect()
    if bad:
        raise ValueError(f"blank or repeated names: {[r['ref'] for r in bad]}")
    refs.select(F.concat(F.lit(">"), "ref", F.lit("\n"), "seq").alias("value")).write.mode("error").text(path)
