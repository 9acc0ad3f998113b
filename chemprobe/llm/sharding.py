"""Sharding by weighted rendezvous hashing of stable record keys. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.llm._shared import gapless, text_or_empty

SHARDS = 8


def rendezvous(keys: list[Column], weights: Sequence[float]) -> Column:
    """The shard (0...) of a record: the one with the highest weighted score.

    The score of shard s is -w_s / ln(u), with u uniform in (0, 1) from a hash of the key and s alone.
    So another shard leaves the others' scores as they are and can only draw rows to itself, and each
    shard's expected share is its weight's. A weight of 0 or less keeps a shard empty. Null keys hash
    to a value of their own. Equal scores go to the lower shard.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("a shard needs a positive weight")
    scored = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            bits = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(f"shard {shard}")), 11)
            uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**53))
            scored.append(F.struct((-F.lit(float(weight)) / F.log(uniform)).alias("score"), F.lit(-shard).alias("s")))
    best = scored[0] if len(scored) == 1 else F.array_max(F.array(*scored))
    return (-best["s"]).cast("int")


def shard(
    df: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    weights: Sequence[float] = (1.0,) * SHARDS,
    column: str = "shard",
) -> DataFrame:
    """Adds the shard of each row; every other column stays as it is.

    Rows with equal keys share a shard, repeated rows included. No shuffle: a map over the rows.
    An empty table stays empty.
    """
    return df.withColumn(column, rendezvous([F.col(f"`{k}`") for k in keys], weights))


def shard_manifest(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, added_weight: float = 1.0) -> DataFrame:
    """Per document: its shard, its place there, and its shard when one more shard is added.

    `slot` numbers each shard's rows from 0 in the order of doc_id (then size, checksum; nulls first).
    Null texts have size 1 and the checksum of the empty text. Only keys, sizes and checksums are
    shuffled, never texts.
    """
    text = text_or_empty("text")
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous([F.col("doc_id")], weights).alias("shard"),
        rendezvous([F.col("doc_id")], [*weights, added_weight]).alias("grown_shard"),
    )
    out = gapless(rows, ["shard"], ["doc_id", "size", "text_crc32"], "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over shards 0 to 7 of equal weight, and over one more."""
    return shard_manifest(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
