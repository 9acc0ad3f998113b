"""Assigning reads to references by barcodes, with mismatches, clipping and a second signature.

A pattern with up to m mismatches contains two of its m + 2 pieces unchanged. So reads' windows are joined
with patterns by equality on (place, two pieces) and then verified by their bits, instead of testing every
read against every reference. Patterns that several references share are sought once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chemprobe.functions.sequences import hamming, reverse_complement
from chemprobe.operators import barcode_bits
from chemprobe.runtime import stored

SECONDARY_TOLERANCE = 2
#: Bases whose windows are cut out of one chunk of a read.
CHUNK = 256
#: Patterns' pieces are broadcast up to so many rows of some 100 bytes; beyond that they are joined by place and piece.
BROADCAST_PROBES = 1_000_000
#: Reads that meet a block of references at once, and the most blocks.
GROUP, BLOCKS = 65_536, 64


def secondary_mismatches(length: Column) -> Column:
    """Mismatches that a second signature may have, by its length."""
    return F.when(length > 20, 4).when(length > 15, 3).when(length >= 5, 2).otherwise(1)


def signatures(library: DataFrame) -> DataFrame:
    """Patterns of `library` (ref, seq, barcode_start, barcode_length, secondary_start, secondary_length).

    Starts are 1-based; each row's own coordinates are used. One row per pattern: ref, kind (bar, rev_bar,
    sec, rev_sec), pattern, and the place where it begins in the reference or its reverse complement.
    """
    cut = lambda s, n: F.when(F.col(n) > 0, F.substring(F.col("seq"), F.col(s), F.col(n)))
    base = library.withColumn("_bar", cut("barcode_start", "barcode_length")).withColumn("_sec", cut("secondary_start", "secondary_length"))
    turned = lambda s, n: F.length("seq") - F.col(s) - F.col(n) + 2
    kinds = [
        ("bar", F.col("_bar"), F.col("barcode_start")), ("rev_bar", reverse_complement(F.col("_bar")), turned("barcode_start", "barcode_length")),
        ("sec", F.col("_sec"), F.col("secondary_start")), ("rev_sec", reverse_complement(F.col("_sec")), turned("secondary_start", "secondary_length")),
    ]
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), p.alias("pattern"), s.cast("int").alias("start")) for k, p, s in kinds])
    return base.select("ref", F.explode(rows).alias("x")).select("ref", "x.*").where(F.col("pattern").isNotNull() & (F.length("pattern") > 0))


def _pieces(n: int, mismatches: int) -> list[list[tuple[int, int]]]:
    """What a pattern of n bases and its window must share: at least one of these lists of (place, length).

    Cut in m + 2 pieces, m mismatches leave two of them as they are. Pieces of under two bases would
    tell too little; then only the place is shared.
    """
    if mismatches == 0:
        return [[(0, n)]]
    k = mismatches + 2
    if n // k < 2:
        return [[]]
    cut = [n * i // k for i in range(k + 1)]
    pieces = [(cut[i], cut[i + 1] - cut[i]) for i in range(k)]
    return [[pieces[i], pieces[j]] for i in range(k) for j in range(i + 1, k)]


def _digits(s: Column) -> Column:
    """A string's letters as hexadecimal digits, one bit of four for each base; other letters have none."""
    return F.translate(F.regexp_replace(s, "[^ACGT]", "0"), "ACGT", "1248")


def _bits(digits: Column, n: int) -> list[Column]:
    """The first n of `_digits` as numbers of up to 15 bases."""
    return [F.conv(F.substring(digits, i + 1, min(15, n - i)), 16, 10).cast("long") for i in range(0, n, 15)]


def _masks(keep: list[tuple[int, int]], n: int) -> list[int]:
    """For each of the numbers of `_bits`, the bits of the pieces in `keep`."""
    held = {at + j for at, k in keep for j in range(k)}
    return [int("".join("f" if i + j in held else "0" for j in range(min(15, n - i))), 16) for i in range(0, n, 15)]


def _seeds(w: str, n: int, mismatches: int) -> Column:
    """A number for each list of pieces, of the place `_at` and the pieces' bits in the array `w`.

    Windows that share one by chance are told apart when they are verified.
    """
    lists = _pieces(n, mismatches)
    piece = lambda keep: [F.col(w)[i].bitwiseAND(F.lit(mask)) for i, mask in enumerate(_masks(keep, n))]
    return F.explode(F.array(*[F.xxhash64("_at", F.lit(i), *piece(keep)) for i, keep in enumerate(lists)])).alias("_seed")


def _matches(reads: DataFrame, patterns: DataFrame, mismatches: int, tolerance: int) -> DataFrame:
    """(read_id, pattern, start) of distinct patterns that lie within `tolerance` of their place in a read.

    Reads are cut to the stretch that the patterns' places span, then to chunks, then to the windows at places
    where a pattern may begin, so the work grows with the bases there. Windows meet patterns by place and shared
    pieces; both are numbers, four bits a base, which also count the mismatches.
    """
    p = patterns.select("pattern", "start").distinct()
    lo = F.greatest(F.col("start") - tolerance, F.lit(1))
    span = p.select(F.length("pattern").alias("n"), lo.alias("lo"), (F.col("start") + tolerance + 1).alias("hi")).groupBy("n").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    tasks = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = None
    for n, first, last in sorted(span):  # a row for each length of pattern
        here = p.where(F.length("pattern") == n).withColumn("_at", F.explode(F.sequence(lo, F.greatest(F.col("start") + tolerance + 1, lo))))
        probes = here.select("pattern", "start", "_at", F.array(*_bits(_digits(F.col("pattern")), n)).alias("_p"))
        places = probes.select("_at").distinct()
        probes = probes.select("pattern", "start", F.col("_at").alias("_there"), "_p", _seeds("_p", n, mismatches))
        if probes.count() <= BROADCAST_PROBES:
            probes, places = F.broadcast(probes), F.broadcast(places)
        stretch = reads.select("read_id", F.substring("seq", first, last - first + n).alias("_s")).where(F.length("_s") >= n)
        chunk = F.explode(F.sequence(F.lit(0), F.expr(f"(length(_s) - {n}) div {CHUNK}"))).alias("_c")
        chunks = stretch.select("read_id", "_s", chunk).select("read_id", "_c", F.substring("_s", F.col("_c") * CHUNK + 1, F.lit(CHUNK + n - 1)).alias("_s"))
        # a number of tasks of its own: chunks are few bytes but many windows
        chunks = chunks.repartition(tasks, "read_id", "_c").withColumn("_d", _digits(F.col("_s")))
        place = F.explode(F.sequence(F.lit(1), F.length("_s") - n + 1)).alias("_i")
        at = (F.col("_c") * CHUNK + F.col("_i") + (first - 1)).cast("int").alias("_at")
        windows = chunks.select("read_id", "_c", "_s", "_d", place).select("read_id", at, F.substring("_s", F.col("_i"), F.lit(n)).alias("_w"), F.substring("_d", F.col("_i"), F.lit(n)).alias("_d"))
        windows = windows.join(places, "_at", "left_semi").select("read_id", "_at", "_w", F.array(*_bits(F.col("_d"), n)).alias("_b"))
        met = windows.select("read_id", "_at", "_w", "_b", _seeds("_b", n, mismatches)).join(probes, "_seed").where("_at = _there")
        if mismatches:
            same = sum((F.bit_count(F.col("_b")[i].bitwiseAND(F.col("_p")[i])) for i in range(len(range(0, n, 15)))), F.lit(0))
            met = met.where(n - same <= mismatches)
        else:
            met = met.where(F.col("_w") == F.col("pattern"))
        found = met.select("read_id", "pattern", "start")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return reads.select("read_id").join(p).where(F.lit(False))
    return out.distinct()


def search(reads: DataFrame, patterns: DataFrame, mismatches: int = 0, tolerance: int = 0) -> DataFrame:
    """(read_id, ref, kind) where a pattern lies within `tolerance` of its place in a read.

    reads: read_id, seq; patterns: ref, kind, pattern, start. A window's two ends are start - tolerance and
    start + length + tolerance, from 1. Letters other than ACGT match nothing.
    """
    found = _matches(reads, patterns, mismatches, tolerance)
    return found.join(patterns.select("ref", "kind", "pattern", "start"), ["pattern", "start"]).select("read_id", "ref", "kind").distinct()


def counts(reads: DataFrame, patterns: DataFrame, mismatches: int = 0, tolerance: int = 0) -> DataFrame:
    """(ref, kind, n_reads) of `search`; reads are counted before references that share a pattern are told apart.

    Where pieces would tell nothing, reads and patterns meet as bits (`barcode_bits`).
    """
    sizes = [r[0] for r in patterns.select(F.length("pattern")).distinct().collect()]
    if any(_pieces(n, mismatches) == [[]] for n in sizes):
        key = F.concat_ws(":", "pattern", "start")
        one = patterns.select(key.alias("ref"), F.lit("bar").alias("kind"), "pattern", "start").distinct()
        n = _in_bits(reads, one, mismatches, tolerance, "counts").groupBy(F.col("ref").alias("_key")).agg(F.sum("bar").alias("n_reads"))
        return patterns.select("ref", "kind", key.alias("_key")).join(n, "_key").select("ref", "kind", "n_reads")
    n = _matches(reads, patterns, mismatches, tolerance).groupBy("pattern", "start").agg(F.count(F.lit(1)).alias("n_reads"))
    return patterns.select("ref", "kind", "pattern", "start").join(n, ["pattern", "start"]).select("ref", "kind", "n_reads")


_COUNTS = (*barcode_bits.BARS, *barcode_bits.SECONDS, "unfiltered", "pre_union")


def _in_bits(reads: DataFrame, patterns: DataFrame, mismatches: int, tolerance: int, what: str) -> DataFrame:
    """What `barcode_bits` finds of groups of reads and blocks of references; each pair is in one task.

    what: "pairs" gives (read_id, ref) of `assigned`; "counts" (ref and _COUNTS), to be summed; "single" (read_id, n,
    ref) of the reads that a block has references for, n up to 2, to be summed; "report" both of these, counts
    without read_id. Blocks have about as many references each, whose last pattern begins at places that are near;
    only the stretches of reads where a block's patterns may lie go to it.
    """
    spark = reads.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    refs = patterns.groupBy("ref").agg(F.max("start").alias("_last"))
    n_refs = refs.count()
    groups = max(1, -(-reads.count() // GROUP))
    ranges = max(1, min(BLOCKS, 2 * tasks // groups, n_refs))
    bounds = sorted({int(x) for x in refs.agg(F.percentile_approx("_last", [i / ranges for i in range(1, ranges)] or [0.5], 10_000)).first()[0] or []}) if ranges > 1 else []
    part = sum((F.when(F.col("_last") > x, 1).otherwise(0) for x in bounds), F.lit(0))
    refs = refs.select("ref", part.alias("_range"))
    # references at one place are cut by their hash
    cuts = {r["_range"]: max(1, round(r["n"] * ranges / max(n_refs, 1))) for r in refs.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    wide, first, total = {}, {}, 0
    for r, n in sorted(cuts.items()):
        wide[r], first[r], total = n, total, total + n
    if not total:
        total, wide, first = 1, {0: 1}, {0: 0}
    of = lambda d: F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), F.col("_range"))
    refs = refs.select("ref", (of(first) + F.pmod(F.xxhash64("ref"), of(wide))).cast("int").alias("_b"))
    second = F.col("kind").isin(*barcode_bits.SECONDS)
    p = patterns.select("ref", "kind", "pattern", "start", F.when(second, secondary_mismatches(F.length("pattern"))).otherwise(mismatches).alias("most")).join(refs, "ref")
    far = F.when(second, SECONDARY_TOLERANCE).otherwise(tolerance)
    ends = p.groupBy("_b", "kind").agg(F.min(F.greatest(F.col("start") - far, F.lit(1))).alias("lo"), F.max(F.greatest(F.col("start") + far + 1, F.lit(1)) + F.length("pattern") - 1).alias("hi")).collect()
    spans: dict[int, list[tuple[int, int]]] = {b: [] for b in range(total)}
    for b, _, lo, hi in sorted(ends, key=lambda r: (r["_b"], r["lo"])):
        if spans[b] and lo <= spans[b][-1][1] + 1:
            spans[b][-1] = (spans[b][-1][0], max(hi, spans[b][-1][1]))
        else:
            spans[b].append((lo, hi))
    columns = max(map(len, spans.values())) or 1
    cut = lambda lo, hi: F.substring("seq", lo, hi - lo + 1)
    stretch = [F.struct(F.lit(b).alias("_b"), *[(cut(*spans[b][i]) if i < len(spans[b]) else F.lit("")).alias(f"s{i}") for i in range(columns)]) for b in range(total)]
    group = F.pmod(F.xxhash64("read_id"), F.lit(groups)).cast("int")
    left = reads.select("read_id", F.length("seq").alias("n"), group.alias("_g"), F.explode(F.array(*stretch)).alias("_x")).select("read_id", "n", (F.col("_x._b") * groups + F.col("_g")).alias("_t"), *[f"_x.s{i}" for i in range(columns)])
    left = left.where(F.col("s0") != "")
    right = p.select(F.explode(F.array(*[F.col("_b") * groups + g for g in range(groups)])).alias("_t"), "ref", "kind", "pattern", "start", "most")
    id_type, ref_type = reads.schema["read_id"].dataType.simpleString(), patterns.schema["ref"].dataType.simpleString()
    kinds = {"read_id": id_type, "ref": ref_type, "n": "int", **dict.fromkeys(_COUNTS, "long")}
    names = {"pairs": ["read_id", "ref"], "single": ["read_id", "n", "ref"], "counts": ["ref", *_COUNTS], "report": list(kinds)}[what]

    def run(key: tuple, some: pa.Table, mine: pa.Table) -> pa.Table:
        types = {"read_id": some.schema.field("read_id").type, "ref": mine.schema.field("ref").type, "n": pa.int32(), **dict.fromkeys(_COUNTS, pa.int64())}
        schema = pa.schema([(c, types[c]) for c in names])
        if not some.num_rows or not mine.num_rows:
            return schema.empty_table()
        letters = bytes(sorted(set("".join(mine.column("pattern").unique().to_pylist()).encode())))
        group_ = barcode_bits.Reads(some, spans[int(key[0].as_py()) // groups], letters)
        out, once, twice = [], np.zeros(group_.words, np.uint64), np.zeros(group_.words, np.uint64)
        firsts: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        add = lambda size, **x: out.append(pa.table([x[c] if c in x else pa.nulls(size, types[c]) for c in names], schema=schema))
        for ref, bits, has in barcode_bits.found(group_, mine, mismatches, tolerance, SECONDARY_TOLERANCE):
            either = bits["bar"] | bits["rev_bar"]
            second_ = bits["sec"] | bits["rev_sec"]
            second_[~has] = ~np.uint64(0)
            got = either & second_
            if what == "pairs":
                row, read = barcode_bits.places(got)
                add(len(row), ref=ref.take(pa.array(row)), read_id=_flat(group_.ids.take(pa.array(read))))
            if what in ("counts", "report"):
                for k in barcode_bits.SECONDS:
                    bits[k] &= either
                n = {k: np.bitwise_count(x).sum(axis=1, dtype=np.int64) for k, x in {**bits, "unfiltered": either, "pre_union": got}.items()}
                keep = n["unfiltered"] > 0
                add(int(keep.sum()), ref=ref.filter(pa.array(keep)), **{k: pa.array(x[keep]) for k, x in n.items()})
            if what in ("single", "report"):
                for i in np.flatnonzero(got.any(axis=1)):
                    twice |= once & got[i]
                    _, read = barcode_bits.places((got[i] & ~once)[None])
                    firsts.append((ref.slice(i, 1), np.zeros(len(read), np.int64), read))
                    once |= got[i]
        for ref, row, read in firsts:
            if len(read):
                n = 1 + (twice[read >> 6] >> (read & 63).astype(np.uint64) & np.uint64(1)).astype(np.int32)
                add(len(read), ref=ref.take(pa.array(row)), read_id=_flat(group_.ids.take(pa.array(read))), n=pa.array(n, pa.int32()))
        return pa.concat_tables(out) if out else schema.empty_table()

    # tasks of their own number: what they read is few bytes, what they do is not
    deal = lambda df: df.repartition(2 * total * groups, "_t").groupBy("_t")
    return deal(left).cogroup(deal(right)).applyInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names))


def _flat(x: pa.ChunkedArray | pa.Array) -> pa.Array:
    return pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x


def assigned_pairs(reads: DataFrame, patterns: DataFrame, mismatches: int = 0, tolerance: int = 0) -> DataFrame:
    """(read_id, ref) of `assigned` for one mate and no clipping; no hit that doesn't count is kept anywhere."""
    return _in_bits(reads, patterns, mismatches, tolerance, "pairs")


def _alone(found: DataFrame) -> DataFrame:
    """(read_id, ref) of the reads of one reference only."""
    return found.groupBy("read_id").agg(F.sum("n").alias("_n"), F.min("ref").alias("ref")).where("_n = 1").select("read_id", "ref")


def assigned_once(reads: DataFrame, patterns: DataFrame, mismatches: int = 0, tolerance: int = 0) -> DataFrame:
    """(read_id, ref) of the reads that `assigned_pairs` gives one reference only; pairs are not listed."""
    return _alone(_in_bits(reads, patterns, mismatches, tolerance, "single"))


def report_one(reads: DataFrame, patterns: DataFrame, mismatches: int = 0, tolerance: int = 0) -> DataFrame:
    """`report` of one mate without clipping, counted where reads meet references; pairs are not listed."""
    found = stored(_in_bits(reads, patterns, mismatches, tolerance, "report"), "report")
    n = found.where("n IS NULL").groupBy("ref").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    final = _alone(found.where("n IS NOT NULL")).groupBy("ref").agg(F.count(F.lit(1)).alias("final_count"))
    out = patterns.select("ref").distinct().join(n, "ref", "left").join(final, "ref", "left").na.fill(0)
    named = {"bar": "init_barcode", "rev_bar": "init_rev_barcode", "sec": "sec_hits", "rev_sec": "rev_sec_hits"}
    out = out.withColumnsRenamed(named).withColumn("reads_lost_to_filter", F.col("unfiltered") - F.col("pre_union"))
    return out.withColumn("lost_to_multihit", F.col("pre_union") - F.col("final_count"))


def clipped(patterns: DataFrame, clip: int) -> DataFrame:
    """Barcodes without their last `clip` bases, to be found exactly where they belong."""
    n = F.length("pattern") - clip
    return patterns.where((F.col("kind") == "bar") & (n > 0)).select("ref", F.lit(f"clip_{clip}").alias("kind"), F.expr(f"substring(pattern, 1, length(pattern) - {clip})").alias("pattern"), (F.col("start") + clip).alias("start"))


def confirm(reads: DataFrame, pairs: DataFrame, patterns: DataFrame, mismatches: Column, tolerance: int) -> DataFrame:
    """(read_id, ref, kind) of `pairs` (read_id, ref) whose read has the reference's pattern in its window.

    Only found pairs are tested, at each of the few places of the window, which is cut out of the read as soon as they meet.
    """
    n, lo = F.length("pattern"), F.greatest(F.col("start") - tolerance, F.lit(1))
    p = patterns.withColumn("_m", mismatches).withColumn("_lo", lo).withColumn("_n", F.greatest(F.col("start") + tolerance + 1, lo) - lo + n)
    near = pairs.join(p, "ref").join(reads.select("read_id", "seq"), "read_id")
    near = near.select("read_id", "ref", "kind", "pattern", "_m", F.expr("substring(seq, _lo, _n)").alias("_s")).where(F.length("_s") >= n)
    fits = lambda i: hamming(F.substring("_s", i, n), F.col("pattern")) <= F.col("_m")
    return near.where(F.exists(F.sequence(F.lit(1), F.length("_s") - n + 1), fits)).select("read_id", "ref", "kind").distinct()


def all_hits(reads: DataFrame, patterns: DataFrame, mismatches: int = 0, tolerance: int = 0, clip: int = 0) -> DataFrame:
    """Every search of one mate: (read_id, ref, kind). Second signatures are sought where a barcode is."""
    bars = patterns.where(F.col("kind").isin("bar", "rev_bar"))
    out = search(reads, bars, mismatches, tolerance)
    for c in range(1, clip + 1):
        out = out.unionByName(search(reads, clipped(patterns, c), 0, 0))
    out = stored(out, "hits")
    second = patterns.where(F.col("kind").isin("sec", "rev_sec"))
    pairs = out.select("read_id", "ref").distinct()
    return out.unionByName(confirm(reads, pairs, second, secondary_mismatches(F.length("pattern")), SECONDARY_TOLERANCE))


def assigned(hits: DataFrame, patterns: DataFrame) -> DataFrame:
    """(read_id, ref): found by barcode, and by the second signature too where the reference has one."""
    flags = hits.groupBy("read_id", "ref").agg(
        F.bool_or(~F.col("kind").isin("sec", "rev_sec")).alias("bar"), F.bool_or(F.col("kind").isin("sec", "rev_sec")).alias("sec")
    )
    has = patterns.groupBy("ref").agg(F.bool_or(F.col("kind") == "sec").alias("has"))
    return flags.join(has, "ref").where(F.col("bar") & (F.col("sec") | ~F.col("has"))).select("read_id", "ref")


def unambiguous(by_mate: DataFrame) -> DataFrame:
    """Of (read_id, ref, mate): reads of one reference only, with the mates that found it (R1, R2, both)."""
    per = by_mate.groupBy("read_id", "ref").agg(F.max((F.col("mate") == 1).cast("int")).alias("a"), F.max((F.col("mate") == 2).cast("int")).alias("b"))
    alone = per.groupBy("read_id").agg(F.count(F.lit(1)).alias("k")).where("k = 1").select("read_id")
    how = F.when(F.col("a") + F.col("b") == 2, "both").when(F.col("a") == 1, "R1").otherwise("R2")
    return per.join(alone, "read_id", "left_semi").select("read_id", "ref", how.alias("found_by"))


def report(hits: DataFrame, patterns: DataFrame, clip: int = 0) -> DataFrame:
    """Counts per reference of the searches of one mate or both, and of the reads that stay.

    hits: read_id, ref, kind, mate. With hits of mate 2 each count has a column for either mate, fq1_ and fq2_.
    All counts come from one pass over the hits, dealt by read.
    """
    kinds = {"bar": "init_barcode", **{f"clip_{c}": f"barcode_clipped_{c}" for c in range(1, clip + 1)}, "rev_bar": "init_rev_barcode", "sec": "sec_hits", "rev_sec": "rev_sec_hits"}
    has = patterns.groupBy("ref").agg(F.bool_or(F.col("kind") == "sec").alias("has"))
    any_of = lambda c: F.bool_or(F.col("kind") == c).alias(kinds[c])
    pairs = hits.repartition("read_id").groupBy("read_id", "ref", "mate").agg(*map(any_of, kinds), F.bool_or(~F.col("kind").isin("sec", "rev_sec")).alias("unfiltered"))
    pairs = pairs.join(F.broadcast(has) if has.count() <= BROADCAST_PROBES else has, "ref")
    pairs = pairs.withColumn("pre_union", F.col("unfiltered") & (F.col("sec_hits") | F.col("rev_sec_hits") | ~F.col("has")))
    # a read stays with its only reference, whichever mate found that
    refs = F.size(F.collect_set(F.when(F.col("pre_union"), F.col("ref"))).over(Window.partitionBy("read_id")))
    pairs = pairs.withColumn("final_count", F.col("pre_union") & (refs == 1)).withColumn("reads_lost_to_filter", F.col("unfiltered") & ~F.col("pre_union")).withColumn("lost_to_multihit", F.col("pre_union") & ~F.col("final_count"))
    names = [*kinds.values(), "unfiltered", "pre_union", "final_count", "reads_lost_to_filter", "lost_to_multihit"]
    n = lambda c, m: F.count(F.when(F.col(c) & (F.col("mate") == m), 1))
    one = [n(c, 1).alias(c) for c in names]
    out = pairs.groupBy("ref").agg(*one, *[n(c, 2).alias(f"fq2_{c}") for c in names])
    out = patterns.select("ref").distinct().join(out, "ref", "left").na.fill(0)
    return out


def report_both(hits: DataFrame, patterns: DataFrame, reads_total: int, clip: int = 0) -> DataFrame:
    """`report` with each mate's counts under fq1_ and fq2_, the file's number of reads and the share that is not used."""
    out = report(hits, patterns, clip)
    out = out.select("ref", *[F.col(c).alias(c if c.startswith("fq2_") else f"fq1_{c}") for c in out.columns if c != "ref"])
    used = Window.partitionBy()
    total = F.sum(F.greatest("fq1_final_count", "fq2_final_count")).over(used)
    return out.withColumn("total_reads", F.lit(reads_total)).withColumn("percent_reads_unused", F.try_divide(100.0 * (reads_total - total), F.lit(reads_total)))


def demultiplex(reads: DataFrame, library: DataFrame, mismatches: int = 0, tolerance: int = 0, clip: int = 0) -> DataFrame:
    """(read_id, ref, found_by) of reads (read_id, mate, seq)."""
    patterns = signatures(library)
    out = None
    for mate in (1, 2):
        mine = reads.where(F.col("mate") == mate).select("read_id", "seq")
        found = assigned(all_hits(mine, patterns, mismatches, tolerance, clip), patterns).withColumn("mate", F.lit(mate))
        out = found if out is None else out.unionByName(found)
    return unambiguous(out)
