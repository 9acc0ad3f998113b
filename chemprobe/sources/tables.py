"""CSV and JSON tables: library, samples, cluster membership, sample documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns with a type; every other column stays text and is carried along.
_INTS = [
    "section_start", "section_end", "barcode_start", "barcode_length", "secondary_signature_start", "secondary_signature_length",
    "temperature_k", "inc_time_tot_secs",
]
_DOUBLES = ["DMS_conc_mM"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A library or samples CSV with its known columns typed; a value that does not fit is null."""
    df = spark.read.csv(path, header=True)
    kinds = {c: "int" for c in _INTS} | {c: "double" for c in _DOUBLES}
    return df.select(*[F.col(c).try_cast("double").cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def write_table(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)


def read_membership(spark: SparkSession, path: str) -> DataFrame:
    """(read, k, i, p) of a CSV with a column `K<k>_<i>` per cluster and a `read` column."""
    if not path.rstrip("/").endswith((".csv", ".csv.gz", ".json")):
        raise ValueError(f"no membership file: {path}")
    df = spark.read.json(path) if path.endswith(".json") else spark.read.csv(path, header=True)
    cols = [c for c in df.columns if c != "read"]
    long = df.unpivot(["read"], cols, "name", "v")
    part = lambda g: F.regexp_extract("name", r"^K(\d+)_(\d+)$", g).cast("int")
    return long.select("read", part(1).alias("k"), part(2).alias("i"), F.col("v").cast("double").alias("p"))


def write_membership(membership: DataFrame, path: str) -> None:
    """One row per read, a column per cluster, gzipped."""
    wide = membership.withColumn("_c", F.format_string("K%d_%d", "k", "i")).groupBy("read").pivot("_c")
    wide.agg(F.first("p")).write.csv(path, header=True, compression="gzip")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files, one row each, as `document`."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("document"))


def write_documents(documents: DataFrame, path: str) -> None:
    documents.select(F.col("document").alias("value"), "sample").write.partitionBy("sample").text(path)
