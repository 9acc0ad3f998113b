"""Streaming profiles: the additive counters over a growing folder of SAM text. Not in batch form only
because sums are: each micro-batch adds to the same groups, so update mode needs no watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.operators.profile import counters
from chemprobe.operators.vectorize import long_form, vectorize
from chemprobe.sources.sam import parse_sam


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """New text files in a folder, as lines."""
    return spark.readStream.schema("value string").text(path)


def streaming_counts(vec: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The profile's sums over a stream of long vectors, for update or complete mode."""
    return vec.groupBy(*(keys or []), "pos").agg(*[c.alias(n) for n, c in counters(F.col("b")).items()])


def add_batch(total_path: str, sections: DataFrame):
    """A foreachBatch function: the batch's reads as vectors, their sums appended as one more part.

    Parts are summed when read (`total`), so a batch that is run again replaces its own part.
    """

    def run(lines: DataFrame, batch_id: int) -> None:
        vec = long_form(vectorize(parse_sam(lines), sections), sections)
        streaming_counts(vec, ["rname", "section"]).write.mode("overwrite").parquet(f"{total_path}/batch={batch_id}")

    return run


def total(spark: SparkSession, total_path: str) -> DataFrame:
    parts = spark.read.parquet(total_path)
    names = [c for c in parts.columns if c not in ("batch", "rname", "section", "pos")]
    return parts.groupBy("rname", "section", "pos").agg(*[F.sum(c).alias(c) for c in names])
