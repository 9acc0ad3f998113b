"""Repeated passages by a two-stage suffix sort, spread over the cluster by content.

A passage of `length` bytes that occurs twice contains the same minimum-hash anchor at the same place
(winnowing), so all its occurrences meet under that anchor. Each start of a possible passage belongs to
one anchor of its text; an anchor's context is the bytes of its starts' passages. Contexts whose anchor
occurs once in the corpus cannot hold a repeat. Equal contexts of one anchor are one text with a
multiplicity, so a large group of copies is sorted once.

The remaining contexts, dealt by anchor, are suffix-sorted: suffixes smaller than their successors are
sorted directly, the rest is induced by one scan over the buckets of first bytes, and the common
prefixes of neighbours then tell which starts repeat. All occurrences of a passage lie in one part, so
the parts together give exactly what one suffix array of the corpus would.

An anchor with very many distinct contexts (a common phrase amid different texts) would fill a part by
itself. Its contexts are cut to runs of a few starts, dealt by the bytes that all passages from such a run
share, which is nearly the passage; what is still too much then is cut to single starts, whose context is
the passage, so that a group holds equal strings and is only counted. Contexts are told apart by two
64-bit hashes, of the anchor and of the context.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.llm._shared import BROADCAST_KEYS, apart, bound_batches, give_back, saved, small_side, text_or_empty, with_row_key

LENGTH = 200
GRAM = 32
#: Anchors per partition of the exchange, and bytes of context per suffix array.
PART_ANCHORS, PART_BYTES = 150_000, 800_000
#: An anchor with more distinct contexts than this is cut finer: to runs of so many starts, then to single ones.
#: So many contexts sort within some 130 MB.
HOT, RUNS = 20_000, (85, 12, 1)
#: Suffixes whose bytes are compared at a time, each with a copy of its passage.
SORTED = 1 << 14
#: A long text's anchors are found so many starts at a time.
_RUN = 1 << 22
_POS = np.uint64((1 << 24) - 1)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * _M1) ^ (np.arange(1, 257, dtype=np.uint64) * _M3 >> np.uint64(7))


def _gram_hashes(t: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h, step = _BYTE[t], 1
        for factor in (0x100000001B3, 0x9E3779B1, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5):
            h = h[: len(h) - step] * np.uint64(factor) + h[step:]
            h ^= h >> np.uint64(29)
            step *= 2
        return h * _M2


def anchors(t: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of the starts 0 ... len(t) - length: runs with one anchor, as (anchor hash, first start, last start, anchor's place)."""
    n = len(t) - length + 1
    w = length - GRAM + 1
    out = []
    for at in range(0, max(n, 0), _RUN):
        m = min(_RUN, n - at)
        h = _gram_hashes(t[at : at + m + length - 1])
        v = (h & ~_POS) | (_POS - np.arange(len(h), dtype=np.uint64))  # of equal hashes, the last one
        size = -(-len(v) // w) * w
        grid = np.full(size, np.iinfo(np.uint64).max, np.uint64)
        grid[: len(v)] = v
        grid = grid.reshape(-1, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        low = np.minimum(back[:m], ahead[w - 1 : w - 1 + m])
        pos = (_POS - (low & _POS)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, pos[1:] != pos[:-1]])
        last = np.r_[first[1:], m] - 1
        out.append((h[pos[first]], first + at, last + at, pos[first] + at))
    if not out:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out))


#: An entry's last start and anchor are stored by their distance from the first start.
_ENTRY = np.dtype([("a", "<u8"), ("c", "<u8"), ("rid", "<i8"), ("s", "<i4"), ("e", "<u2"), ("p", "<u2")])
_ENTRIES = "a long, c long, _rid long, s int, e int, p int"


def _anchor_blobs(parts: int, length: int):
    """Packed entries dealt to parts: (anchor, context hash, row, first start, last start, anchor's place).

    An anchor that a batch of texts holds twice is shared for certain: one entry goes to the anchor's part,
    to tell the others, and the rest to a part of the batch's own, below 0. So a part gets a common anchor
    once a batch.
    """

    def pack(found: list[np.ndarray], own: int) -> pd.DataFrame:
        all_ = np.concatenate(found)
        all_ = all_[np.argsort(all_["a"], kind="stable")]
        first = np.r_[True, all_["a"][1:] != all_["a"][:-1]]
        last = np.r_[first[1:], True]
        sure = all_[~first]
        all_, twice = all_[first], ~last[first]
        # the high bits of a window's smallest hash are nearly all zero; the low ones are even
        part = ((all_["a"] & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        all_, twice, ends = all_[order], twice[order], np.searchsorted(part[order], np.arange(parts + 1))
        rows = [(p, twice[ends[p] : ends[p + 1]].tobytes() + all_[ends[p] : ends[p + 1]].tobytes()) for p in range(parts) if ends[p] < ends[p + 1]]
        if len(sure):
            rows.append((own, np.ones(len(sure), bool).tobytes() + sure.tobytes()))
        return pd.DataFrame(rows, columns=["part", "blob"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        found, n, own = [], 0, -1 - (TaskContext.get().partitionId() << 24)
        for batch in batches:
            for rid, text in zip(batch["_rid"], batch["text"]):
                raw = (text or "").encode()
                if len(raw) < length:
                    continue
                a, s, e, p = anchors(np.frombuffer(raw, np.uint8), length)
                one = np.empty(len(a), _ENTRY)
                one["a"], one["rid"], one["s"], one["e"], one["p"] = a, rid, s, e - s, p - s
                view = memoryview(raw)
                one["c"] = np.fromiter((xxhash.xxh3_64_intdigest(view[i : j + length]) for i, j in zip(s.tolist(), e.tolist())), np.uint64, len(a))
                found.append(one)
                n += len(a)
                if n >= 200_000:
                    yield pack(found, own)
                    found, n, own = [], 0, own - 1
        if found:
            yield pack(found, own)

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        """The entries whose anchor occurs twice or more."""
        sizes = [len(b) // (_ENTRY.itemsize + 1) for b in group["blob"]]
        sure = np.concatenate([np.frombuffer(b, bool, n) for b, n in zip(group["blob"], sizes)])
        all_ = np.concatenate([np.frombuffer(b, _ENTRY, n, n) for b, n in zip(group["blob"], sizes)])
        order = np.argsort(all_["a"], kind="stable")
        a = all_["a"][order]
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        size = np.diff(np.r_[first, len(a)])
        keep = all_[order[(np.repeat(size, size) > 1) | sure[order]]]
        s, a, c = keep["s"], *(np.ascontiguousarray(keep[x]).view(np.int64) for x in "ac")
        return pd.DataFrame({"a": a, "c": c, "_rid": keep["rid"], "s": s, "e": s + keep["e"], "p": s + keep["p"]})

    return run, shared


def _finer(width: int, length: int):
    """Cuts contexts to runs of at most `width` starts, each dealt by what all its passages share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["a", "c", "off", "mult", "a2", "c2", "_rid", "s", "e", "p"]
        for batch in batches:
            rows = []
            for rid, text, spots in zip(batch["_rid"], batch["text"], batch["spots"]):
                raw = memoryview(text.encode())
                for x in spots:
                    p, end = x["p"], x["e"]
                    while end >= x["s"]:  # from the last start back, by distance to the anchor
                        j = (p - end) // width
                        start = max(x["s"], p - j * width - width + 1)
                        common = raw[p - j * width : p - j * width - width + 1 + length]
                        a2 = xxhash.xxh3_64_intdigest(common, seed=j)
                        c2 = xxhash.xxh3_64_intdigest(raw[start : end + length], seed=p - start + 1)
                        rows.append((x["a"], x["c"], start - x["s"], x["mult"], a2 - (a2 >> 63 << 64), c2 - (c2 >> 63 << 64), rid, start, end, p))
                        end = start - 1
                if len(rows) >= 20000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    return run, "a long, c long, off int, mult long, a2 long, c2 long, _rid long, s int, e int, p int"


def rises(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the empty one, after the last, is smallest."""
    step = np.sign(np.diff(t.astype(np.int16), append=-1)).astype(np.int8)
    at = np.where(step != 0, np.arange(len(t)), len(t))
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    return step[nxt] > 0


def _contexts(parts: int, length: int):
    """Cuts the contexts out of the texts, each with the run down to the next directly sorted suffix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, spots in zip(batch["text"], batch["spots"]):
                raw = text.encode()
                up = np.flatnonzero(rises(np.frombuffer(raw, np.uint8)))
                for x in spots:
                    s, e = x["s"], x["e"]
                    k = np.searchsorted(up, e)
                    ended = k == len(up)
                    last = len(raw) - 1 if ended else int(up[k])
                    part = (x["a"] >> 8 & 0xFFFFFF) % parts
                    rows.append((part, x["a"], x["c"], x["mult"], e - s + 1, last - s + 1, ended, raw[s : min(len(raw), last + length)]))
                    if len(rows) >= 20000:
                        yield pd.DataFrame(rows, columns=["part", "a", "c", "mult", "starts", "n", "ended", "bytes"])
                        rows = []
            yield pd.DataFrame(rows, columns=["part", "a", "c", "mult", "starts", "n", "ended", "bytes"])

    return run


def _laid_out(t: np.ndarray, off: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each suffix that counts: its text, its place there and its place in `t`."""
    kind = np.int32 if len(t) + LENGTH < 1 << 31 else np.int64
    owner = np.repeat(np.arange(len(off), dtype=kind), n)
    place = np.arange(len(owner), dtype=kind) - np.repeat((np.cumsum(n) - n).astype(kind), n)
    return owner, place, np.repeat(off.astype(kind), n) + place


def _by_bytes(padded: np.ndarray, at: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """The order, a stable one, of the `depth` bytes from each place `at`; bytes from `left` on count as zero.

    Eight bytes are sorted first; whole bytes are then compared among those that are equal, SORTED places at a time.
    """
    width = min(8, depth)

    def bytes_at(some: np.ndarray, width: int) -> np.ndarray:
        keys = np.lib.stride_tricks.sliding_window_view(padded, width)[at[some]]
        cut = np.flatnonzero(left[some] < width)  # near a text's end: nothing of the next text counts
        keys[cut] *= np.arange(width) < left[some[cut], None]
        return keys

    eight = np.zeros((len(at), 8), np.uint8)
    eight[:, :width] = bytes_at(np.arange(len(at), dtype=at.dtype), width)
    key = eight.view(">u8").ravel().astype(np.uint64)
    del eight
    order = np.argsort(key, kind="stable").astype(at.dtype)
    if depth <= 8:
        return order
    key = key[order]
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    del key
    i = 0
    while i < len(edge) - 1:
        j = max(i + 1, int(np.searchsorted(edge, edge[i] + SORTED, side="right")) - 1)
        a, b = edge[i], edge[j]
        if b - a > j - i:  # some are equal
            some = order[a:b]
            if b - a > SORTED:
                order[a:b] = some[_by_bytes(padded, at[some] + 8, left[some] - 8, depth - 8)]
            else:
                order[a:b] = some[np.argsort(bytes_at(some, depth).view(f"V{depth}").ravel(), kind="stable")]
        i = j
    return order


def two_stage_order(t: np.ndarray, off: np.ndarray, size: np.ndarray, n: np.ndarray, ended: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes in order, to `depth` bytes, of several texts laid end to end in `t`.

    Text i lies at off[i], has size[i] bytes, and its first n[i] suffixes count; the last of these is
    smaller than its successor, or else (`ended`) it is the text's last byte.
    """
    total = int(n.sum())
    owner, place, at = _laid_out(t, off, n)
    final = np.cumsum(n) - 1
    step = np.empty(total, np.int8)
    step[:] = np.sign(t[np.minimum(at + 1, len(t) - 1)].astype(np.int16) - t[at])
    step[final] = np.where(ended, -1, 1)
    nxt = np.minimum.accumulate(np.where(step != 0, np.arange(total, dtype=at.dtype), at.dtype.type(total))[::-1])[::-1]
    small = step[nxt] > 0  # smaller than the successor: sorted directly
    del nxt, step
    direct = np.flatnonzero(small).astype(at.dtype)
    left = size.astype(at.dtype)[owner[direct]] - place[direct]
    direct = direct[_by_bytes(np.r_[t, np.zeros(depth, np.uint8)], at[direct], left, depth)]
    first = t[at]
    del owner, at, left
    bounds = np.searchsorted(first[direct], np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(ids: np.ndarray) -> None:
        """Puts the larger predecessors of `ids`, in their order, at the ends of their buckets."""
        before = ids[place[ids] > 0] - 1
        before = before[~small[before]]
        if len(before):
            chars = first[before]
            order = np.argsort(chars, kind="stable")
            before, chars = before[order], chars[order]
            cuts = np.flatnonzero(np.r_[True, chars[1:] != chars[:-1]])
            for piece, c in zip(np.split(before, cuts[1:]), chars[cuts]):
                buckets[c].append(piece)

    ends = final[ended]
    if len(ends):  # the empty suffix after each end is the smallest of all
        order = np.argsort(first[ends], kind="stable")
        for c in np.unique(first[ends]):
            buckets[c].append(ends[order][first[ends][order] == c])
    out = []
    for c in range(256):
        k = 0
        while k < len(buckets[c]):
            induce(buckets[c][k])
            k += 1
        mine = direct[bounds[c] : bounds[c + 1]]
        out.extend(buckets[c])
        out.append(mine)
        induce(mine)
    return np.concatenate(out)


def repeated_starts(texts: list[bytes], starts: np.ndarray, n: np.ndarray, ended: np.ndarray, mult: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """Per text, which of its first `starts` positions begin a passage that begins elsewhere too."""
    size = np.array([len(x) for x in texts], np.int64)
    off = np.cumsum(size) - size
    t = np.frombuffer(b"".join(texts), np.uint8)
    sa = two_stage_order(t, off, size, n, ended, length)
    owner, place, at = _laid_out(t, off, n)
    sa = sa[place[sa] < starts[owner[sa]]]
    at = at[sa]
    del place
    # common prefixes of neighbours, eight bytes at a time, up to `length`
    words = np.lib.stride_tricks.as_strided(np.r_[t, np.zeros(8, np.uint8)], (len(t), 8), (1, 1))
    alive = np.arange(max(len(sa) - 1, 0))
    for k in range(0, length, 8):
        width = min(8, length - k)
        a = np.ascontiguousarray(words[at[alive] + k, :width])
        b = np.ascontiguousarray(words[at[alive + 1] + k, :width])
        same = (a.view("<u8").ravel() == b.view("<u8").ravel()) if width == 8 else (a == b).all(axis=1)
        alive = alive[same]
        if not len(alive):
            break
    again = np.zeros(len(sa), bool)
    again[alive] = again[alive + 1] = True
    again |= mult[owner[sa]] > 1
    flags = np.zeros(len(owner), bool)
    flags[sa[again]] = True
    return np.split(flags, np.cumsum(n)[:-1])


def _sort_part(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        n = group["n"].to_numpy(np.int64)
        found = repeated_starts(list(group["bytes"]), group["starts"].to_numpy(np.int64), n, group["ended"].to_numpy(bool), group["mult"].to_numpy(np.int64), length)
        rows = []
        for a, c, flags in zip(group["a"], group["c"], found):
            if flags.any():
                edge = np.flatnonzero(np.diff(np.r_[False, flags, False]))
                rows.append((a, c, edge[::2].tolist(), (edge[1::2] - 1).tolist()))
        del group, found
        give_back()
        return pd.DataFrame(rows, columns=["a", "c", "lo", "hi"])

    return run


def _spans(at: np.ndarray, to: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(at, kind="stable")
    at, to = at[order], np.maximum.accumulate(to[order])
    new = np.r_[True, at[1:] > to[:-1]]
    return list(zip(at[new].tolist(), to[np.r_[np.flatnonzero(new)[1:] - 1, len(to) - 1]].tolist()))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for rid, text, at, to in zip(batch["_rid"], batch["text"], batch["at"], batch["to"]):
            raw = text.encode()
            spans = _spans(np.array(at), np.array(to))
            kept, last = [], 0
            for a, b in spans:
                kept.append(raw[last:a])
                last = b
            left = b"".join([*kept, raw[last:]])
            rows.append((rid, [{"at": a, "to": b} for a, b in spans], sum(b - a for a, b in spans), hashlib.sha256(left).hexdigest(), left.decode(errors="ignore")))
        yield pd.DataFrame(rows, columns=["_rid", "spans", "n_removed", "kept_sha256", "left"])


def _spots(contexts: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts that contexts are cut out of, with those contexts; a text's own number of them is bounded by it."""
    here = contexts.groupBy("_rid").agg(F.collect_list(F.struct("a", "c", "mult", "s", "e", "p")).alias("spots"))
    rows = saved(contexts.select("_rid").distinct(), "rows-with-contexts")
    if rows.count() <= BROADCAST_KEYS:  # only these texts are dealt by key
        texts = texts.join(F.broadcast(rows), "_rid", "left_semi")
    return texts.join(here, "_rid").select("_rid", "text", "spots")


def _distinct(entries: DataFrame, mult: Column) -> DataFrame:
    """(a, c, mult, _rid, s, e, p): each distinct context once, with its number and one of its places."""
    spot = F.min(F.struct("_rid", "s", "e", "p")).alias("r")
    return entries.groupBy("a", "c").agg(mult.alias("mult"), spot).select("a", "c", "mult", "r.*")


def _hot(contexts: DataFrame) -> DataFrame:
    """The anchors with more than HOT distinct contexts."""
    return saved(contexts.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("a"), "hot-anchors")


def _repeats(contexts: DataFrame, texts: DataFrame, length: int, runs: tuple[int, ...]) -> DataFrame:
    """(a, c, lo, hi): the runs of starts within each distinct context, from 0, that repeat."""
    hot = _hot(contexts)
    if not hot.head(1):
        return _sorted_repeats(contexts, texts, length)
    hot_side = small_side(hot)
    cool, warm = contexts.join(hot_side, "a", "left_anti"), contexts.join(hot_side, "a", "left_semi")
    cut, schema = _finer(runs[0], length)
    finer = saved(_spots(warm, texts).mapInPandas(cut, schema), f"runs-of-{runs[0]}")
    # most runs share their bytes with no other and are done with
    met = saved(finer.groupBy("a2").agg(F.sum("mult").alias("m")).where("m > 1").select("a2"), "runs-met")
    finer = finer.join(small_side(met), "a2", "left_semi")
    again = finer.select(F.col("a2").alias("a"), F.col("c2").alias("c"), "mult", "_rid", "s", "e", "p")
    again = saved(_distinct(again, F.sum("mult")), "finer-contexts")
    if runs[0] == 1:  # a context is its passage: counted, there is nothing to sort
        found = again.where("mult > 1").select("a", "c", F.array(F.lit(0)).alias("lo"), F.array(F.lit(0)).alias("hi"))
    else:
        found = _repeats(again, texts, length, runs[1:])
    found = found.select(F.col("a").alias("a2"), F.col("c").alias("c2"), "lo", "hi")
    shift = lambda side: F.transform(side, lambda x: x + F.col("off")).alias(side)
    back = finer.join(saved(found, "finer-repeats"), ["a2", "c2"]).select("a", "c", shift("lo"), shift("hi"))
    return _sorted_repeats(cool, texts, length).unionByName(back)


def _sorted_repeats(contexts: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The same by suffix sorts of parts that hold all contexts of an anchor."""
    size = contexts.agg(F.sum(F.col("e") - F.col("s") + length)).first()[0] or 0
    cut = _spots(contexts, texts).select("text", "spots").mapInPandas(
        _contexts(max(4, -(-size // PART_BYTES)), length), "part int, a long, c long, mult long, starts int, n int, ended boolean, bytes binary"
    )
    return cut.groupBy("part").applyInPandas(_sort_part(length), "a long, c long, lo array<int>, hi array<int>")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of `docs` (_rid, text) with a repeat: _rid, spans in bytes, n_removed, kept_sha256, left.

    A passage has at most 65,535 bytes. `left` is what remains, without bytes of cut-up characters. A text shorter than `length`, or null,
    has no repeat. Repeats within one text count, overlapping ones included. `_rid` tells rows apart and
    has to be the same whenever `docs` is read, as `with_row_key` gives it.
    """
    bound_batches(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4, -(-2 * total // ((length - GRAM + 2) * PART_ANCHORS)))
    make, shared = _anchor_blobs(parts, length)
    blobs = docs.mapInPandas(make, "part long, blob binary")
    met = saved(blobs.groupBy("part").applyInPandas(shared, _ENTRIES), "anchors")
    rows = saved(met.select("_rid").distinct(), "rows-with-anchors")
    texts = saved(docs.join(small_side(rows), "_rid", "left_semi"), "texts-with-anchors")
    contexts = saved(_distinct(met, F.count(F.lit(1))), "contexts")
    hits = saved(_repeats(contexts, texts, length, RUNS), "repeats")
    ranges = met.join(hits, ["a", "c"]).select(
        "_rid", F.transform("lo", lambda x: x + F.col("s")).alias("at"), F.transform("hi", lambda x: x + F.col("s") + length).alias("to")
    )
    per = ranges.groupBy("_rid").agg(F.flatten(F.collect_list("at")).alias("at"), F.flatten(F.collect_list("to")).alias("to"))
    return texts.join(per, "_rid").mapInPandas(
        _cut, "_rid long, spans array<struct<at:int,to:int>>, n_removed long, kept_sha256 string, left string"
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` with the repeated passages cut out of `text` (and n_chars, if there, counted anew).

    Every row stays, emptied ones too, and every repeated row; rows without a repeat, null texts among them,
    stay as they are. Other columns stay whatever their names. An empty table stays empty. Only rows with a
    repeat are shuffled while their keys can be sent to every task.
    """
    inner, restore = apart(docs, ("text", "n_chars"))
    rows = with_row_key(inner)
    cut = saved(repeated_spans(rows.select("_rid", "text"), length).select("_rid", "left"), "texts-left")
    keys = small_side(saved(cut.select("_rid"), "rows-cut"))
    changed = rows.join(keys, "_rid", "left_semi").drop("text").join(cut, "_rid").withColumnRenamed("left", "text")
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return restore(rows.join(keys, "_rid", "left_anti").unionByName(changed))


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null and empty texts have no bytes and no repeats; repeated rows give repeated results.
    """
    rows = with_row_key(docs.select("doc_id", text_or_empty("text").alias("text")))
    cut = repeated_spans(rows.select("_rid", "text"), length)
    cut = saved(cut.select("_rid", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"), "cuts")
    about = rows.select("_rid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole"))
    none = F.lit(0).cast("long")
    return about.join(cut, "_rid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256")
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the repeats of 200 bytes leave of every document."""
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
