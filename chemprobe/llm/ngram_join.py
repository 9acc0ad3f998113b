"""N-gram Jaccard join by universe-partition pigeonhole.

A text's set holds its distinct five-word shingles, as 64-bit hashes. Two sets A and B with
100 * |A and B| >= 80 * |A or B| differ in at most D = (|A| + |B|) / 9 elements. A hash deals all
elements to m segments, m by size band; each differing element spoils one segment. If a set gives its
segments v = 0, 1 or 2 credits so that the credits sum to more than D, then some segment with v = 1 is
equal in both sets, or some segment with v = 2 differs by one element at most.

Every set publishes the signature of each segment's subset, and for some segments also those of the
subset without each one of its elements (the one-deletion neighbourhood). Counts of all signatures
then price the credits: a subset found nowhere else costs nothing, a frequent one costs its list. Each
set takes its cheapest credits, so common passages are probed only when nothing rarer is left.
Candidates are verified on the whole sets. A set whose free credits suffice has no partner at all.

Sets that are equal are one class from the start. In each list, the classes that ask are first compared
with two of its members; only pairs in a list that are still in different components are compared
further, and of those only pairs whose parity maps, a lower bound of their difference, are close enough. So a large
group of near copies does not cost all its pairs, and no link that joins two components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chemprobe.llm._shared import Saved, apart, bound_batches, saved, small_side
from chemprobe.llm.components import components

WORDS = 5
#: Signatures per partition of the exchange.
PART_ROWS = 1_500_000
#: Every so many-th segment also publishes its one-deletion neighbourhood.
DELETE_EVERY = 16
#: A set in more pairs than this is copied for each so many of them.
HUB = 64
_LEVELS = 64
_KEEP_WORDS = 200_000

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_OWN, _DELETED, _EMPTY, _NEEDED = 0, 1, 2, 3


def _mix(x: np.ndarray) -> np.ndarray:
    """Splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEEP_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def _distinct(x: np.ndarray) -> np.ndarray:
    x.sort()
    new = np.empty(len(x), bool)
    new[0] = True
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles: five words each, or all words when there are fewer.

    Words are what ASCII white space parts, with A-Z in lower case. Without words: empty.
    """
    words = (text or "").encode().lower().split()  # bytes: lower() and split() know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    a = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    k = min(WORDS, len(a))
    with np.errstate(over="ignore"):
        h = a[: len(a) - k + 1] + np.uint64(k)
        for i in range(1, k):
            h = h * _M1 + a[i : len(a) - k + 1 + i]
        return _distinct(_mix(h))


def _level_tops() -> np.ndarray:
    tops, x = [], 8.0
    for _ in range(_LEVELS):
        tops.append(int(x))
        x *= 1.6
    return np.array(tops, dtype=np.float64)


#: Level k serves the pairs whose larger set has at most _TOPS[k] elements (and more than the one before).
_TOPS = _level_tops()


def levels_of(n: int) -> list[int]:
    """The size bands in which a set of n elements can be the larger or the smaller of a pair."""
    return sorted({int(np.searchsorted(_TOPS, n)), int(np.searchsorted(_TOPS, (5 * n) // 4))})


def segments_of(level: int) -> int:
    h = int(2 * _TOPS[level] // 9)
    return max(6, int((h + 1) * 1.15) + 1)


def need_of(n: int, level: int) -> int:
    """Credits that a set of n elements needs against partners that are not larger.

    The larger set of a pair asks, in its own band; in the next one it only answers.
    """
    return 2 * n // 9 + 1 if level == levels_of(n)[0] else 0


def _segments(s: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each element's hash and segment in a band, and the segments' sizes."""
    m = segments_of(level)
    with np.errstate(over="ignore"):
        e = _mix(s + _M1 * np.uint64(level + 1))
        seg = ((e >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    return e, seg, np.bincount(seg, minlength=m)


#: Of a set's segments, the deletion segments: every DELETE_EVERY-th of the first so many.
_SLOTTED = slice(0, 255 * DELETE_EVERY, DELETE_EVERY)
#: Segments are told apart in signatures' low bits up to this number; beyond it they share places.
_SEGMENTS = 1 << 14


def _parity(e: np.ndarray, level: int) -> list[int]:
    """A bit map in which each element has flipped one bit: two sets differ in as many elements at least as bits."""
    width = -(-2 * int(_TOPS[level]) // 64) * 64
    odd = np.bincount(((e & np.uint64(0xFFFFFFFF)) * np.uint64(width) >> np.uint64(32)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _own(s: np.ndarray, level: int) -> tuple[np.ndarray, ...]:
    """A band's segment signatures before tags, with what they are made of."""
    e, seg, sizes = _segments(s, level)
    with np.errstate(over="ignore"):
        order = np.argsort(seg, kind="stable")
        e = _mix(e[order] * _M1)
        used = np.flatnonzero(sizes)
        ends = np.cumsum(sizes[used])
        total = np.zeros(len(sizes), np.uint64)
        total[used] = np.add.reduceat(e, ends - sizes[used])
        salt = _M2 * np.arange(1, len(sizes) + 1, dtype=np.uint64) + _M3 * np.uint64(level + 1)
        return _mix(total + salt), sizes, total, salt, e, seg[order]


def bands(s: np.ndarray) -> tuple[int, list[dict]]:
    """The number of a set's signatures, and what it needs and has in each of its bands."""
    total, out = 0, []
    for level in levels_of(len(s)) if len(s) else []:
        e, _, sizes = _segments(s, level)
        slotted = sizes[_SLOTTED]
        total += len(sizes) + int(slotted.sum())
        about = (level, need_of(len(s), level), int(np.count_nonzero(sizes)), int(np.count_nonzero(slotted)), _parity(e, level))
        out.append(dict(zip(("level", "need", "used", "dels", "parity"), about)))
    return total, out


def signatures(s: np.ndarray) -> np.ndarray:
    """All signatures of a set that is not empty.

    The low bits of a signature tell what it is: 2 bits of kind, 6 of level, 14 of segment.
    """
    out = []
    with np.errstate(over="ignore"):
        for level in levels_of(len(s)):
            mixed, sizes, total, salt, e, seg = _own(s, level)
            slotted = np.zeros(len(sizes), bool)
            slotted[_SLOTTED] = True
            tag = np.uint64(level << 2) | (np.arange(len(sizes), dtype=np.uint64) % np.uint64(_SEGMENTS)) << np.uint64(8)
            low = ~np.uint64(0x3FFFFF)
            own = (mixed & low) | tag
            too_few = np.count_nonzero(sizes) + np.count_nonzero(sizes[_SLOTTED]) < need_of(len(s), level)
            own[sizes == 0] |= np.uint64(_NEEDED if too_few else _EMPTY)
            out.append(own)
            pick = np.flatnonzero(slotted[seg])
            at = seg[pick]
            out.append((_mix(total[at] - e[pick] + salt[at]) & low) | tag[at] | np.uint64(_DELETED))
    return np.concatenate(out)


_CLASS_SCHEMA = "doc_id long, n long, h1 long, h2 long, n_sigs long, bands array<struct<level:int,need:int,used:int,dels:int,parity:array<long>>>"


def _set_hashes(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a, b = _mix(s * _M2 + _M3).sum(dtype=np.uint64), _mix(s * _M3 + _M1).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            s = shingle_set(text)
            h1, h2 = _set_hashes(s)
            rows.append((doc_id, len(s), h1, h2, *bands(s)))
        yield pd.DataFrame(rows, columns=["doc_id", "n", "h1", "h2", "n_sigs", "bands"]).astype({"doc_id": "Int64"})
    _words.clear()  # the worker goes on to other tasks


def _blob_maker(parts: int):
    """Deals signatures to `parts` by value, packed: classes, then signatures with the class's place."""

    def pack(sigs: list[np.ndarray], classes: list[int]) -> pd.DataFrame:
        of = np.repeat(np.arange(len(sigs), dtype=np.uint32), [len(x) for x in sigs])
        sig = np.concatenate(sigs)
        part = ((sig >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, sig, of = part[order], sig[order], of[order]
        ids = np.array(classes, np.int64)
        ends = np.searchsorted(part, np.arange(parts + 1))
        rows = []
        for p in range(parts):
            a, b = ends[p], ends[p + 1]
            if a < b:
                mine, place = np.unique(of[a:b], return_inverse=True)
                small = place.astype(np.uint16 if len(mine) <= 65536 else np.uint32)
                head = np.array([len(mine), b - a, small.itemsize], np.int64)
                rows.append((p, head.tobytes() + ids[mine].tobytes() + sig[a:b].tobytes() + small.tobytes()))
        return pd.DataFrame(rows, columns=["part", "blob"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sigs, classes, seen, size = [], [], set(), 0
        for batch in batches:
            for text in batch["text"]:
                s = shingle_set(text)
                h1, h2 = _set_hashes(s)
                if not len(s) or (h1, h2) in seen:
                    continue
                seen.add((h1, h2))
                sigs.append(signatures(s))
                classes.append(h1)
                size += len(sigs[-1])
                if size >= 2_000_000:
                    yield pack(sigs, classes)
                    sigs, classes, seen, size = [], [], set(), 0
        if sigs:
            yield pack(sigs, classes)
        _words.clear()

    return run


_LIST_SCHEMA = "sig long, kind int, level int, seg int, h1 long, n_own long, n_all long"


def _lists(group: pd.DataFrame) -> pd.DataFrame:
    """Of one part: the entries of signatures that two classes share, with the sizes of their lists."""
    sigs, ids = [], []
    for blob in group["blob"]:
        n_ids, n, width = np.frombuffer(blob, np.int64, 3)
        own = np.frombuffer(blob, np.int64, n_ids, 24)
        sigs.append(np.frombuffer(blob, np.uint64, n, 24 + 8 * n_ids))
        ids.append(own[np.frombuffer(blob, np.uint16 if width == 2 else np.uint32, n, 24 + 8 * n_ids + 8 * n)])
    sig, h1 = np.concatenate(sigs), np.concatenate(ids)
    key = sig >> np.uint64(2)
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, len(key)])
    keep = order[np.repeat(size, size) > 1]
    frame = pd.DataFrame({"sig": (sig[keep] >> np.uint64(2)).view(np.int64), "kind": (sig[keep] & np.uint64(3)).astype(np.int32), "h1": h1[keep]})
    frame = frame.drop_duplicates()
    frame["n_own"] = (frame["kind"] != _DELETED).astype(np.int64)
    frame["need"] = frame["kind"].isin([_NEEDED, _DELETED])
    by = frame.groupby("sig", sort=False)
    frame["n_all"], frame["least"], frame["most"] = by["h1"].transform("size"), by["h1"].transform("min"), by["h1"].transform("max")
    frame["n_own"] = by["n_own"].transform("sum")
    # lists of empty segments matter only to a set that has too few others, or has one element there
    real = (frame["least"] != frame["most"]) & (frame["n_own"] > 0) & (~frame["kind"].isin([_EMPTY, _NEEDED]) | by["need"].transform("any"))
    frame = frame[real]
    low = frame["sig"].to_numpy()
    frame = frame.assign(level=(low & 63).astype(np.int32), seg=((low >> 6) & (_SEGMENTS - 1)).astype(np.int32))
    return frame[["sig", "kind", "level", "seg", "h1", "n_own", "n_all"]]


def _probes(lists: DataFrame, bands: DataFrame) -> DataFrame:
    """Each class's cheapest credits, as far as its free ones do not suffice: (node, sig)."""
    slotted = (F.col("seg") % DELETE_EVERY == 0) & (F.col("seg") < 255 * DELETE_EVERY) & F.col("kind").isin(_OWN, _DELETED)
    per = lists.groupBy("node", "level").agg(
        F.count(F.when(F.col("kind") == _OWN, 1)).alias("own"), F.countDistinct(F.when(slotted, F.col("seg"))).alias("slots")
    )
    free = (F.col("used") - F.col("own")) + (F.col("dels") - F.col("slots"))
    left = per.join(bands.where("need > 0"), ["node", "level"]).select("node", "level", (F.col("need") - free).alias("left")).where("left > 0")
    rows = lists.join(left, ["node", "level"])
    first = rows.where(F.col("kind").isin(_OWN, _NEEDED)).select("node", "left", F.lit(-1).alias("seg"), "sig", (F.col("n_own") - 1).alias("cost"))
    second = rows.where(slotted).groupBy("node", "left", "seg").agg(F.lit(None).cast("long").alias("sig"), F.sum("n_all").alias("cost"))
    w = Window.partitionBy("node").orderBy("cost", "seg", "sig")
    taken = first.unionByName(second).withColumn("r", F.row_number().over(w)).where("r <= left")
    near = taken.where("seg >= 0").select("node", "seg").join(rows.where(slotted).select("node", "seg", "sig"), ["node", "seg"])
    return taken.where("seg < 0").select("node", "sig").unionByName(near.select("node", "sig")).distinct()


#: Of two sets' parity maps x and y and their sizes nx and ny: whether they can reach the threshold.
_CAN_LINK = """5 * least(nx, ny) >= 4 * greatest(nx, ny)
    AND 9 * aggregate(zip_with(x, y, (a, b) -> bit_count(a ^ b)), 0, (s, c) -> s + c) <= nx + ny"""


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"node": batch["node"], "items": [shingle_set(t).view(np.int64) for t in batch["text"]]})
    _words.clear()


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose whole sets reach the threshold; sets are made only for texts in a pair."""
    nodes = pairs.select(F.col("u").alias("doc_id")).unionByName(pairs.select(F.col("v").alias("doc_id"))).distinct()
    texts = docs.join(nodes, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text")
    sets = saved(texts.mapInPandas(_sets, "node long, items array<long>"), "items")
    # a set that very many pairs share (a hub, always v) is copied, so that its pairs are dealt to many tasks
    hubs = pairs.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HUB).select("v", F.ceil(F.col("n") / HUB).cast("int").alias("copies"))
    hubs = small_side(saved(hubs, "hubs"))
    copies = F.coalesce("copies", F.lit(1))
    a = sets.select(F.col("node").alias("u"), F.col("items").alias("su"))
    b = sets.select(F.col("node").alias("v"), F.col("items").alias("sv")).join(hubs, "v", "left")
    b = b.select("v", "sv", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    salted = pairs.join(hubs, "v", "left").select("u", "v", F.pmod(F.xxhash64("u"), copies).cast("int").alias("copy"))
    both = salted.join(b, ["v", "copy"]).join(a, "u")
    both = both.withColumn("x", F.size(F.array_intersect("su", "sv")))
    return both.where(100 * F.col("x") >= 80 * (F.size("su") + F.size("sv") - F.col("x"))).select("u", "v").distinct()


def _labelled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) of all `nodes`: those without an edge are components of their own."""
    found = nodes.join(components(edges), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    return saved(found, "labels")


def link_classes(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id.

    component_id is the smallest doc_id that links reach. Null and empty texts have no shingles and
    are linked with nothing. Rows that repeat a text are one class. A row without doc_id gets a null
    component and links nothing. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = Saved(docs.mapInPandas(_describe, _CLASS_SCHEMA), "sets").df
    parts = max(4, -(-int(described.agg(F.sum("n_sigs")).first()[0] or 0) // PART_ROWS))
    some = described.where("n > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    classes = saved(classes, "classes")

    bands = classes.select("node", F.explode("bands").alias("b")).select("node", "b.*")

    blobs = docs.where("doc_id IS NOT NULL").select("text").mapInPandas(_blob_maker(parts), "part int, blob binary")
    found = Saved(blobs.groupBy("part").applyInPandas(_lists, _LIST_SCHEMA), "shared-signatures")
    lists = saved(found.df.join(classes.select("h1", "node", "n"), "h1").drop("h1"), "lists")
    found.drop()
    maps = bands.select("node", "level", "parity")
    probes = _probes(lists, bands).withColumn("asks", F.lit(True))
    asked = probes.select("sig").distinct()
    # of the lists that someone asks, all members; and of each one's two ends, what they may link with
    lists = lists.select("node", "n", "sig", "kind", "level").join(asked, "sig", "left_semi").join(probes, ["node", "sig"], "left")
    lists = saved(lists.withColumn("asks", F.coalesce("asks", F.lit(False))), "asked-lists")
    ends = lists.groupBy("sig").agg(F.min(F.struct("node", "n")).alias("a"), F.max(F.struct("node", "n")).alias("b"))
    star = lists.where("asks").join(ends, "sig").select("node", "n", "level", F.explode(F.array("a", "b")).alias("e"))
    star = star.select("node", "n", "level", F.col("e.node").alias("other"), F.col("e.n").alias("m")).where("node <> other").distinct()
    star = star.join(maps, ["node", "level"]).withColumnsRenamed({"parity": "x", "n": "nx", "m": "ny"})
    star = star.join(maps.select(F.col("node").alias("other"), "level", F.col("parity").alias("y")), ["other", "level"]).where(_CAN_LINK)
    star = saved(star.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).distinct(), "star")
    edges = saved(_verified(star, docs), "links")
    labels = _labelled(lists.select("node").distinct(), edges)

    # what is left: pairs in a list that are in different components; one of them is outside the
    # component that most of the list is in, so these few meet the list and not the list itself
    rows = lists.join(labels.select("node", "root"), "node")
    roots = rows.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("k"))
    most = roots.groupBy("sig").agg(F.max(F.struct("k", "root")).alias("most"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    rows = rows.join(most.select("sig", F.col("most.root").alias("most")), "sig").join(maps, ["node", "level"])
    rows = saved(rows.select("sig", "kind", "node", "n", "root", "asks", "parity", (F.col("root") != F.col("most")).alias("few")), "mixed-lists")
    few = rows.where("few").select("sig", F.col("kind").alias("kx"), F.col("node").alias("u"), F.col("n").alias("nx"), F.col("root").alias("rx"), F.col("asks").alias("ax"), F.col("parity").alias("x"))
    rest = rows.select("sig", F.col("kind").alias("ky"), F.col("node").alias("v"), F.col("n").alias("ny"), F.col("root").alias("ry"), F.col("asks").alias("ay"), F.col("parity").alias("y"))
    larger_asks = "((ax AND nx >= ny) OR (ay AND ny >= nx))"
    pairs = few.join(rest, (few["sig"] == rest["sig"]) & F.expr(f"rx <> ry AND {larger_asks} AND NOT (kx = {_DELETED} AND ky = {_DELETED}) AND {_CAN_LINK}"))
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = saved(pairs.join(star, ["u", "v"], "left_anti"), "rest")
    edges = saved(edges.unionByName(_verified(pairs, docs)), "all-links")

    roots = components(edges)
    of = classes.select("h1", "h2", "n", "node").join(roots, "node", "left").select("h1", "h2", "n", F.coalesce("root", "node").alias("root"))
    joined = described.select("doc_id", "n", "h1", "h2").join(of, ["h1", "h2", "n"], "left")
    own = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(own, F.col("root")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are their component's smallest doc_id, with their columns as they were.

    Rows that repeat a doc_id stay or go together. Rows without an id, and null or empty texts, stay. An empty
    table stays empty.
    """
    linked = link_classes(docs.select("doc_id", "text"))
    gone = small_side(saved(linked.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "near-copies"))
    inner, restore = apart(docs, ("doc_id",))
    return restore(inner.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and the component that its links reach."""
    return link_classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP2_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda y: y <> '') AS ws
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
x AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM x JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 80 * (a.n + b.n - k)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.v FROM r JOIN e ON e.u = r.reached)
SELECT w.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.reached) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = w.doc_id GROUP BY w.doc_id
"""
