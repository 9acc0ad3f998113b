"""Token ids in blocks by an adaptive context-mixing range coder.

A block is coded on its own: its models start anew, and a checksum covers its ids. Each id's probability is
a mixture of three predictions. Orders 2 and 1 each predict an id, what followed the last two ids (or the
last one) before, with a confidence; order 0 predicts all ids by adaptive counts. The weights of the three
are probabilities that adapt for each pair of confidences. Where orders 2 and 1 predict the same id their
weights are one. The mixture's share of an id is an interval of a carryless range coder with 64 bits.

A block's ids are cut into equal stretches, a numpy lane each, and the coder steps through all lanes
together. The lanes share the block's models, which learn from all lanes after each step; so the decoder,
which has the same ids by then, learns the same.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chemprobe.llm._shared import bound_batches, remove, saved, small_side
from chemprobe.llm._tokens import in_lots, library_encoder

MAGIC = b"CPRC2"
END = 2
#: Ids of the vocabulary file that the query takes.
VOCABULARY = 49408
#: Ids of a block, its lanes at most, and the ids of a lane at least.
BLOCK, LANES, STRETCH = 1 << 22, 8192, 512
_U = np.uint64
_TOP, _BOT, _ALL = _U(1 << 48), _U(1 << 42), _U(0xFFFFFFFFFFFFFFFF)
_WORD = _U(16)
#: What an id seen adds to its count of 1 in order 0, and the steps between refreshes of order 0's sums.
_GAIN, _EVERY = 24, 8
_ONE, _TWO = 16, 18  # bits of the context tables
#: Weights are parts of 65536; order 0 keeps at least _REST, and a weight moves as fast as after so many ids.
_REST, _INERTIA = 64, 48


def lanes_of(n: int) -> tuple[int, int]:
    """Lanes and steps of a block of n ids."""
    lanes = max(1, min(LANES, n // STRETCH))
    return lanes, -(-n // lanes)


class _Models:
    """A block's models. Coder and decoder make the same calls in the same order."""

    def __init__(self, lanes: int, vocab: int):
        self.vocab = vocab
        self.counts = np.zeros(vocab, np.int64)
        self.one, self.two = np.zeros(1 << _ONE, np.int64), np.zeros(1 << _TWO, np.int64)
        self.two_share, self.one_share = np.zeros(32, np.int64), np.zeros(32, np.int64)
        # of the slots (confidence of order 2, of order 1, agreement): where either predicts an id of its own
        slot = np.arange(32)
        self.has_two, self.has_one = slot >> 3 > 0, (slot >> 1 & 3 > 0) & (slot & 1 == 0)
        self.two_share[self.has_two] = self.one_share[self.has_one] = 1 << 14
        self.last = self.before_last = np.zeros(lanes, np.int64)

    def refresh(self, recent: np.ndarray | None) -> None:
        """Brings order 0 up to date with the ids since the last time."""
        if recent is not None:
            self.counts += np.bincount(recent.ravel(), minlength=self.vocab)
        sums = np.cumsum(self.counts * _GAIN + 1)
        self.after = sums.astype(np.uint64)
        self.before = np.concatenate([np.zeros(1, np.uint64), self.after[:-1]])
        self.total = self.after[-1]

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Order 2's id and weight, order 1's id and weight; a weight of 0 where there is no id."""
        self.k1 = self.last & ((1 << _ONE) - 1)
        self.k2 = (self.last * 40503 + self.before_last * 60493 >> 3) & ((1 << _TWO) - 1)
        self.e1, self.e2 = self.one[self.k1], self.two[self.k2]
        self.i1, self.i2 = self.e1 >> 2, self.e2 >> 2
        self.slot = (self.e2 & 3) << 3 | (self.e1 & 3) << 1 | (self.e1 >> 2 == self.e2 >> 2) & (self.e2 & 3 > 0)
        return self.i2, self.two_share[self.slot].astype(np.uint64), self.i1, self.one_share[self.slot].astype(np.uint64)

    def learn(self, ids: np.ndarray, by_two: np.ndarray, by_one: np.ndarray) -> None:
        n = np.bincount(self.slot, minlength=32)
        for share, hit, has in ((self.two_share, by_two, self.has_two), (self.one_share, by_one, self.has_one)):
            hits = np.bincount(self.slot[hit], minlength=32)
            share += ((hits << 16) - n * share) // (n + _INERTIA)
            np.clip(share, 8, 65536 - 2 * _REST, out=share)
            share[~has] = 0
        np.minimum(self.one_share, 65536 - _REST - self.two_share, out=self.one_share)
        for table, key, entry, guess in ((self.one, self.k1, self.e1, self.i1), (self.two, self.k2, self.e2, self.i2)):
            conf, same = entry & 3, guess == ids
            # right: surer; wrong: less sure while it was sure at all, else the new id
            table[key] = np.where(same, entry + (conf < 3), np.where(conf > 1, entry - 1, ids << 2 | 1))
        self.before_last, self.last = self.last, ids


def _moves(low: np.ndarray, rng: np.ndarray) -> np.ndarray:
    return ((low ^ (low + rng)) < _TOP) | (rng < _BOT)


def _shift(low: np.ndarray, rng: np.ndarray, out) -> None:
    """Moves settled words out of `low`; `out` is told the lanes each time. Ranges stay over _BOT."""
    move = np.flatnonzero(_moves(low, rng))
    while len(move):
        l, r = low[move], rng[move]
        cut = (r < _BOT) & ((l ^ (l + r)) >= _TOP)
        if cut.any():
            r = np.where(cut, (~l + _U(1)) & (_BOT - _U(1)), r)
        out(move, l)
        low[move] = l = l << _WORD
        rng[move] = r = r << _WORD
        move = move[_moves(l, r)]


def encode_block(ids: np.ndarray, vocab: int) -> bytes:
    """The payload of a block of ids: each lane's number of 16-bit words, then the lanes' words."""
    lanes, steps = lanes_of(len(ids))
    grid = np.full(lanes * steps, END % vocab, np.int64)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = _Models(lanes, vocab)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, _ALL)
    cap = 3 * steps + 8
    words, pos, base = np.zeros(lanes * cap, np.uint16), np.zeros(lanes, np.int64), np.arange(lanes) * cap

    def out(move: np.ndarray, l: np.ndarray) -> None:
        at = pos[move]
        words[base[move] + at] = (l >> _U(48)).astype(np.uint16)
        pos[move] = at + 1

    with np.errstate(over="ignore"):
        for t in range(steps):
            if t % _EVERY == 0 or t < _EVERY:
                model.refresh(grid[max(t - _EVERY if t > _EVERY else t - 1, 0) : t] if t else None)
            now = grid[t]
            i2, w2, i1, w1 = model.predict()
            by_two = (now == i2) & (w2 > 0)
            by_one = (now == i1) & (w1 > 0)
            unit = rng >> _WORD
            first, second = unit * w2, unit * w1
            rest = first + second
            miss = np.flatnonzero(~(by_two | by_one))
            low += np.where(by_two, _U(0), np.where(by_one, first, rest))
            rng = np.where(by_two, first, np.where(by_one, second, rng - rest))
            if len(miss):
                found = now[miss]
                r = rng[miss] // model.total
                start = model.before[found]
                low[miss] += r * start
                rng[miss] = r * (model.after[found] - start)
            _shift(low, rng, out)
            model.learn(now, by_two, by_one)
        # two more words name a value within the range; the reader takes zeros for the rest
        low += rng >> _U(1)
        for _ in range(2):
            out(np.arange(lanes), low)
            low <<= _WORD
    body = words.reshape(lanes, cap)[np.arange(cap) < pos[:, None]]
    return pos.astype("<u4").tobytes() + body.astype("<u2").tobytes()


def decode_block(payload: bytes, n: int, vocab: int) -> np.ndarray:
    """The n ids of a payload."""
    lanes, steps = lanes_of(n)
    size = np.frombuffer(payload, "<u4", lanes).astype(np.int64)
    cap = int(size.max()) + 3 * steps + 12  # a damaged payload may ask for more words than it has
    words, base, pos = np.zeros(lanes * cap, np.uint16), np.arange(lanes) * cap, np.zeros(lanes, np.int64)
    words.reshape(lanes, cap)[np.arange(cap) < size[:, None]] = np.frombuffer(payload, "<u2", int(size.sum()), 4 * lanes)
    model = _Models(lanes, vocab)
    low, rng, code = np.zeros(lanes, np.uint64), np.full(lanes, _ALL), np.zeros(lanes, np.uint64)
    grid = np.zeros((steps, lanes), np.int64)

    def more(move: np.ndarray, _: np.ndarray) -> None:
        at = pos[move]
        code[move] = code[move] << _WORD | words[base[move] + np.minimum(at, cap - 1)].astype(np.uint64)
        pos[move] = at + 1

    with np.errstate(over="ignore"):
        for _ in range(4):
            more(np.arange(lanes), low)
        for t in range(steps):
            if t % _EVERY == 0 or t < _EVERY:
                model.refresh(grid[max(t - _EVERY if t > _EVERY else t - 1, 0) : t] if t else None)
            i2, w2, i1, w1 = model.predict()
            unit = rng >> _WORD
            first, second = unit * w2, unit * w1
            rest, here = first + second, code - low
            by_two = here < first
            by_one = ~by_two & (here < rest)
            miss = np.flatnonzero(here >= rest)
            now = np.where(by_two, i2, i1)
            low += np.where(by_two, _U(0), np.where(by_one, first, rest))
            rng = np.where(by_two, first, np.where(by_one, second, rng - rest))
            if len(miss):
                r = rng[miss] // model.total
                want = np.minimum((code[miss] - low[miss]) // r, model.total - _U(1))
                now[miss] = found = np.searchsorted(model.after, want, side="right")
                start = model.before[found]
                low[miss] += r * start
                rng[miss] = r * (model.after[found] - start)
            _shift(low, rng, more)
            grid[t] = now
            # order 2's id may also be order 1's, as the coder sees it
            model.learn(now, (now == i2) & (w2 > 0), (now == i1) & (w1 > 0))
    return grid.T.ravel()[:n]


def pack_blocks(blocks: list[tuple[np.ndarray, list[tuple[int, int | None, int]]]], vocab: int) -> list[bytes]:
    """Blocks of (ids, segments) as bytes; a segment is (document's number, doc_id, ids of it here).

    Layout, little-endian: magic, vocabulary size u32, ids u32, segments u32, checksum of the ids as u32 u32;
    per segment number i64, doc_id present u8, doc_id i64, ids u32; the payload. An id outside the vocabulary
    is a ValueError.
    """
    out = []
    for ids, segments in blocks:
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= vocab):
            raise ValueError(f"an id is outside the vocabulary of {vocab}")
        head = MAGIC + struct.pack("<IIII", vocab, len(ids), len(segments), zlib.crc32(ids.astype("<u4").tobytes()))
        table = b"".join(struct.pack("<qBqI", k, d is not None, d or 0, n) for k, d, n in segments)
        out.append(head + table + encode_block(ids, vocab))
    return out


def unpack_blocks(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, list[tuple[int, int | None, int]]]]:
    """What `pack_blocks` was given; a damaged block raises ValueError."""
    for blob in blobs:
        if blob[:5] != MAGIC:
            raise ValueError("not a block")
        vocab, n, k, check = struct.unpack_from("<IIII", blob, 5)
        rows = [struct.unpack_from("<qBqI", blob, 21 + 21 * i) for i in range(k)]
        ids = decode_block(blob[21 + 21 * k :], n, vocab)
        if zlib.crc32(ids.astype("<u4").tobytes()) != check:
            raise ValueError("a block's checksum is wrong")
        yield ids, [(a, d if present else None, m) for a, present, d, m in rows]


def crc32_combine(a: int, b: int, length: int) -> int:
    """The crc32 of two byte strings end to end, from theirs and the second one's length."""
    matrix = [0xEDB88320, *(1 << k for k in range(31))]  # one zero bit

    def times(m: list[int], v: int) -> int:
        out, k = 0, 0
        while v:
            if v & 1:
                out ^= m[k]
            v >>= 1
            k += 1
        return out

    square = lambda m: [times(m, x) for x in m]
    matrix = square(square(square(matrix)))  # one zero byte
    while length:
        if length & 1:
            a = times(matrix, a)
        matrix = square(matrix)
        length >>= 1
    return a ^ b


def _writer(path: str, vocab: int, end: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, encode, tail = TaskContext.get().partitionId(), library_encoder(path), np.array([end], "<u4").tobytes()
        ready: list = []
        parts: list[np.ndarray] = []
        segments: list[tuple[int, int | None, int]] = []
        room, number, block = BLOCK, 0, 0

        def flush() -> pd.DataFrame:
            nonlocal ready, block
            blobs = pack_blocks(ready, vocab)
            out = pd.DataFrame({"part": part, "block": np.arange(block, block + len(blobs)), "n_ids": [len(x) for x, _ in ready], "blob": blobs})
            block += len(blobs)
            ready = []
            return out

        for batch in batches:
            at = 0
            for lot in in_lots(batch["text"]):
                for doc_id, raw in zip(batch["doc_id"][at : at + len(lot)], encode(lot)):
                    ids = np.frombuffer(raw + tail, "<u4")
                    doc = None if pd.isna(doc_id) else int(doc_id)
                    while len(ids):
                        now, ids = ids[:room], ids[room:]
                        parts.append(now)
                        segments.append((number, doc, len(now)))
                        room -= len(now)
                        if not room:
                            ready.append((np.concatenate(parts), segments))
                            parts, segments, room = [], [], BLOCK
                            yield flush()
                    number += 1
                at += len(lot)
        if parts:
            ready.append((np.concatenate(parts), segments))
        if ready:
            yield flush()

    return run


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str, vocab: int, end: int = END) -> None:
    """Writes the ids of `docs` (doc_id, text) to `folder`, in ascending doc_id order (null first).

    The table there has one row per block: part and block, which give the order, n_ids, and blob.
    Texts are dealt by range of doc_id, so that each task writes one stretch of the order. Null and
    empty texts are the end id alone.
    """
    bound_batches(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]  # bounds of ranges hold no texts
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = ranged.mapInPandas(_writer(tokenizer_path, vocab, end), "part int, block int, n_ids int, blob binary")
    blocks.write.parquet(folder)


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part, block, blob in zip(batch["part"], batch["block"], batch["blob"]):
            rows, at = [], 0
            for ids, table in unpack_blocks([blob]):
                raw = ids.astype("<u4").tobytes()
                for number, doc, n in table:
                    rows.append((part, number, block, doc, at, n, zlib.crc32(raw[4 * at : 4 * (at + n)])))
                    at += n
            yield pd.DataFrame(rows, columns=["part", "number", "block", "doc_id", "at", "n", "crc"]).astype({"doc_id": "Int64"})


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        crcs = []
        for segments in batch["segments"]:
            crc, first = 0, True
            for x in segments:
                crc, first = (x["crc"] if first else crc32_combine(crc, x["crc"], 4 * x["n"])), False
            crcs.append(crc)
        yield batch[["doc_id", "start", "n_tokens"]].astype({"doc_id": "Int64"}).assign(ids_crc32=crcs)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document in `folder`: doc_id, start, n_tokens, ids_crc32.

    Starts come from the blocks' counts: within each part by a window over its blocks, and over the
    parts, of which there is one per writing task. Parts of a long document are joined by number. The files
    are read before this returns, so that they may be deleted then.
    """
    blocks = spark.read.parquet(folder)
    counts = blocks.select("part", "block", "n_ids")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("p", before(Window.orderBy("part"))).drop("n")
    places = counts.withColumn("n", F.col("n_ids").cast("long")).withColumn("b", before(Window.partitionBy("part").orderBy("block")))
    places = places.join(small_side(saved(parts, "parts")), "part").select("part", "block", (F.col("p") + F.col("b")).alias("start"))
    places = saved(places, "places")
    found = blocks.select("part", "block", "blob").mapInPandas(_reader, "part int, number long, block int, doc_id long, at int, n int, crc long")
    # blocks are decoded where they are read; only their small rows meet the places
    rows = saved(found, "segments").join(places, ["part", "block"]).withColumn("start", F.col("start") + F.col("at"))
    whole = rows.groupBy("part", "number").agg(
        F.max("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "n", "crc"))).alias("segments"),
    )
    one = whole.where(F.size("segments") == 1).select("doc_id", "start", "n_tokens", F.col("segments")[0]["crc"].alias("ids_crc32"))
    more = whole.where(F.size("segments") > 1).mapInPandas(_whole, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return one.unionByName(more)


def op10_token_output(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """All documents' ids written and read back: where each one's lie, and their checksum."""
    import uuid

    import public_tokenizers

    from chemprobe.llm._shared import shared_dir

    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    folder = f"{shared_dir(spark)}/chemprobe/token-ids-{uuid.uuid4().hex}"
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path, folder, VOCABULARY)
    found = read_ids(spark, folder)
    remove(spark, folder)
    return found
