"""Packing into fixed-length sequences as a cutting-stock problem, solved by column generation.

A document's ids are cut at multiples of the sequence length; each full piece is a sequence of its own
and only the last piece is an item to pack. Items are counted by length class. A linear program over
patterns (how many items of each class share a sequence) is solved by column generation: its dual
prices go to a knapsack dynamic program, which finds the best new pattern until none pays. The rounded
patterns then take the items of each class in the order of their ranks.

The driver only ever sees the length histogram, which has a fixed number of classes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chemprobe.llm._shared import bound_batches, gapless, saved
from chemprobe.llm._tokens import in_lots, library_encoder

LENGTH = 1024
END = 0
#: Tokens per length class: items count as the next multiple.
CLASS = 8


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The pattern of the highest price that fits: an unbounded knapsack by dynamic programming."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        fit = np.searchsorted(sizes, c, side="right")
        if fit:
            got = value[c - sizes[:fit]] + prices[:fit]
            k = int(got.argmax())
            if got[k] > value[c] + 1e-12:
                value[c], last[c] = got[k], k
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= sizes[last[c]]
    return pattern


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 20000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a row) and how often each is used, fractions allowed, with the fewest sequences.

    `sizes` ascend. Revised simplex with the basis inverse kept up to date; it starts with patterns of
    one class each. Ends when no pattern's price exceeds 1 by more than a ten-thousandth: by Farley's
    bound the result is then within that of the optimum.
    """
    m = len(sizes)
    patterns = np.diag(capacity // sizes)
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ demand
    for _ in range(rounds):
        prices = inverse.sum(axis=0)
        new = best_pattern(np.maximum(prices, 0.0), sizes, capacity)
        if prices @ new <= 1 + 1e-4:
            break
        d = inverse @ new
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        r = int(ratio.argmin())
        step = ratio[r]
        x -= step * d
        x[r] = step
        np.maximum(x, 0, out=x)
        patterns[r] = new
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
    return patterns.reshape(m, m), x


def plan(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole patterns and their counts that use each class exactly `demand` times.

    The linear program's counts are rounded down; what is left, a bounded number of items, is packed
    first-fit by falling size.
    """
    if not len(sizes):
        return []
    patterns, x = column_generation(sizes, demand.astype(float), capacity)
    left, out = demand.copy(), []
    for k in np.argsort(-x, kind="stable"):
        uses = patterns[k] > 0
        count = min(int(x[k] + 1e-9), int((left[uses] // patterns[k][uses]).min()))
        if count > 0:
            out.append((patterns[k].copy(), count))
            left -= count * patterns[k]
    room: list[int] = []
    filled: list[np.ndarray] = []
    for j in range(len(sizes) - 1, -1, -1):
        start = 0
        for _ in range(int(left[j])):
            while start < len(room) and room[start] < sizes[j]:
                start += 1
            if start == len(room):
                room.append(capacity)
                filled.append(np.zeros(len(sizes), np.int64))
            room[start] -= int(sizes[j])
            filled[start][j] += 1
    return out + [(p, 1) for p in filled]


def _pieces(path: str, length: int, end: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, tail = library_encoder(path), np.array([end], "<u4").tobytes()
        for batch in batches:
            rows, at = [], 0
            for lot in in_lots(batch["text"]):
                for doc_id, raw in zip(batch["doc_id"][at : at + len(lot)], encode(lot)):
                    raw = raw + tail
                    n = len(raw) // 4
                    for s in range(0, n, length):
                        part = raw[4 * s : 4 * (s + length)]
                        rows.append((doc_id, s, len(part) // 4, zlib.crc32(part), n))
                at += len(lot)
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).astype({"doc_id": "Int64"})

    return run


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Per piece of `docs` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone. Rows that repeat an id are packed each on their own. An
    empty table gives an empty result. Texts are encoded in a map and never shuffled.
    """
    bound_batches(docs.sparkSession)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = saved(source.mapInPandas(_pieces(tokenizer_path, length, end), schema), "pieces")
    found = found.withColumn("class", F.when(F.col("length") < length, F.ceil(F.col("length") / CLASS)).otherwise(0).cast("int"))
    histogram = {r["class"]: r["n"] for r in found.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = np.array(sorted(k for k in histogram if k), np.int64)
    chosen = plan(classes, np.array([histogram[k] for k in classes], np.int64), -(-length // CLASS))

    rows, taken, base = [], dict.fromkeys(classes.tolist(), 0), 0
    for pattern, count in chosen:
        slot = 0
        for j in np.flatnonzero(pattern)[::-1]:
            k, per = int(classes[j]), int(pattern[j])
            rows.append((k, taken[k], taken[k] + per * count, per, base, slot))
            taken[k] += per * count
            slot += per
        base += count
    if histogram.get(0):
        rows.append((0, 0, histogram[0], 1, base, 0))
    spark = docs.sparkSession
    shares = spark.createDataFrame(rows, "k int, lo long, hi long, per long, base long, slot long")
    ranked = gapless(found, ["class"], ["doc_id", "start", "length", "ids_crc32"], "_rank")
    # a share for each pattern and class: bounded by the classes' number, whatever the input
    on = (F.col("class") == F.col("k")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    placed = ranked.join(F.broadcast(shares), on)
    within = F.col("_rank") - F.col("lo")
    placed = placed.withColumn("sequence_id", F.col("base") + F.expr("(_rank - lo) div per")).withColumn("_slot", F.col("slot") + within % F.col("per"))
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0).cast("long"))
    return placed.withColumn("offset", offset).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """All documents in sequences of at most 1024 ids."""
    import public_tokenizers

    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path)
