"""Quality classifier on supervised subword embeddings.

A document's features are its words, its words' character n-grams (3 to 5, with word edges) and its
word pairs, hashed to a fixed number of buckets. Each bucket has a learned vector; a document is the
mean of its features' vectors, and a softmax layer turns it into a probability. Vectors and layer are
trained together by stochastic gradient descent in numpy, on a bounded sample of labelled rows.

With two classes the softmax needs only the difference of two scores, which is linear in the mean; so
scoring folds vectors and layer into one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chemprobe.llm._shared import bound_batches
from chemprobe.llm._tokens import in_lots

#: The bounded sample: at most so many labelled rows, chosen by a hash of doc_id.
TRAIN_ROWS = 3000
#: And of those, in that order, as many as have so many characters together.
TRAIN_CHARS = 60_000_000
BUCKETS, DIMENSIONS, EPOCHS, RATE, SEED = 1 << 18, 12, 6, 0.5, 7
#: Vectors learn at a higher rate than the layer, as a mean spreads its gradient over all features; a document's
#: step for them is clipped to a norm of 1.
VECTOR_RATE = 60
_KEEP_WORDS = 250_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _bucket(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(20)).astype(np.int64) % BUCKETS


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct words: all their buckets laid end to end, how many each has, and a hash of each."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    t = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    room = np.repeat(starts + sizes, sizes) - np.arange(len(t))  # characters up to the word's end
    owner = np.repeat(np.arange(len(words)), sizes)
    with np.errstate(over="ignore"):
        letter = (t + np.uint64(1)) * _M1
        letter ^= letter >> np.uint64(32)
        place = np.arange(len(t)) - np.repeat(starts, sizes)
        whole = np.add.reduceat(letter * _M2 * (place * 2 + 1).astype(np.uint64) ^ letter, starts)
        out, of = [_bucket(whole)], [np.arange(len(words))]
        h = letter.copy()
        for n in range(2, 6):
            h = h[: len(t) - n + 1] * np.uint64(0x100000001B3) + letter[n - 1 :]
            if n >= 3:
                ok = np.flatnonzero(room[: len(h)] >= n)
                out.append(_bucket(h[ok] + np.uint64(n)))
                of.append(owner[ok])
    owner, flat = np.concatenate(of), np.concatenate(out)
    order = np.argsort(owner, kind="stable")
    return flat[order], np.bincount(owner, minlength=len(words)), whole


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """The buckets of a document's adjacent words, from the words' hashes.

    All pairs of a word with itself share one bucket, so that repetition is learned whatever the word.
    """
    with np.errstate(over="ignore"):
        pairs = _bucket(hashes[:-1] * _M1 + hashes[1:])
    pairs[hashes[:-1] == hashes[1:]] = 0
    return pairs


@dataclass
class Model:
    """One number per bucket and an offset: the log odds of a document are their mean and the offset."""

    weights: np.ndarray
    offset: float


def document_features(text: str) -> np.ndarray:
    words = (text or "").encode().split()  # ASCII white space
    if not words:
        return np.empty(0, np.int64)
    words = [w.decode() for w in words]
    known = list(dict.fromkeys(words))
    flat, counts, hashes = word_features(known)
    at = {w: k for k, w in enumerate(known)}
    idx = np.fromiter((at[w] for w in words), np.int64, len(words))
    ends = np.cumsum(counts)
    parts = np.split(flat, ends[:-1])
    return np.concatenate([*(parts[k] for k in idx), pair_features(hashes[idx])])


def train(texts: list[str], labels: list[int], seed: int = SEED) -> Model:
    """Learns vectors and softmax layer by SGD, one document a step, at a falling rate.

    Classes are weighted to equal mass. With one class or no rows the model is that class's odds.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.zeros(2, np.float32)
    docs = [np.unique(document_features(t), return_counts=True) for t in texts]
    y = np.asarray(labels, np.int64)
    mass = np.bincount(y, minlength=2)
    weight = np.where(mass > 0, len(y) / np.maximum(2 * mass, 1), 0)
    steps, k = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            idx, count = docs[i]
            share = (count / max(count.sum(), 1)).astype(np.float32)
            mean = share @ vectors[idx] if len(idx) else np.zeros(DIMENSIONS, np.float32)
            score = layer @ mean + bias
            p = np.exp(score - score.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = (p * (RATE * (1 - k / steps) * weight[y[i]])).astype(np.float32)
            back = layer.T @ g
            layer -= np.outer(g, mean)
            bias -= 0.1 * g
            if len(idx):
                step = VECTOR_RATE * np.outer(share, back)
                vectors[idx] -= step / max(1.0, float(np.linalg.norm(step)))
            k += 1
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


class Scorer:
    """Scores texts by a model, with a bounded cache of words."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sums = np.empty(0, np.float64)
        self.counts = np.empty(0, np.int64)
        self.hashes = np.empty(0, np.uint64)

    def __call__(self, texts: list[str]) -> list[float]:
        if len(self.known) > _KEEP_WORDS:
            self._reset()
        split = [t.encode().split() for t in texts]
        new = list(set().union(*split).difference(self.known)) if split else []
        for at in range(0, len(new), 10_000):  # the features of so many words at a time
            some = new[at : at + 10_000]
            flat, counts, hashes = word_features([w.decode() for w in some])
            sums = np.add.reduceat(self.model.weights[flat].astype(np.float64), np.cumsum(counts) - counts)
            self.known.update(zip(some, range(len(self.sums), len(self.sums) + len(some))))
            self.sums, self.counts, self.hashes = np.append(self.sums, sums), np.append(self.counts, counts), np.append(self.hashes, hashes)
        out = []
        for words in split:
            odds = self.model.offset
            if words:
                idx = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                pairs = pair_features(self.hashes[idx])
                total = self.sums[idx].sum() + self.model.weights[pairs].sum(dtype=np.float64)
                odds += total / (self.counts[idx].sum() + len(pairs))
            out.append(float(1 / (1 + np.exp(-np.clip(odds, -60, 60)))))
        return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Trains on at most `rows` of the labelled documents that are not held out, of TRAIN_CHARS characters together.

    The sample is the rows with the smallest hashes of doc_id, then the smaller id and label; rows without a
    label or id are passed over, and null texts are empty. Of rows that repeat an id one is taken, before
    anything is sent to the driver.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out()).select("doc_id", "quality").distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    once = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    once = once.groupBy("doc_id").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    sample = once.join(chosen, "doc_id")
    # a window over the sample alone, at most `rows` rows
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
    sample = sample.withColumn("n", F.sum(F.length("text")).over(so_far)).where(F.col("n") <= TRAIN_CHARS)
    sample = sample.select("doc_id", "text", "quality").orderBy("doc_id", "quality").toPandas()
    return train(sample["text"].tolist(), sample["quality"].tolist())


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, held_out, score, predicted. A map without a shuffle.

    Null and empty texts get the score of the offset alone. Repeated rows score alike.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for batch in batches:
            found = np.array([x for lot in in_lots(batch["text"]) for x in scorer(lot)], np.float64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": found})

    bound_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = source.mapInPandas(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, by a model of the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
