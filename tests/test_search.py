"""The barcode search against a plain loop over every read, place and pattern."""

import random

import pytest

from chemprobe.operators import demultiplex as dm


def plain(reads, patterns, mismatches, tolerance):
    out = set()
    for read, s in reads:
        for ref, kind, p, start in patterns:
            for at in range(max(start - tolerance, 1), max(start + tolerance + 1, 1) + 1):
                w = s[at - 1 : at - 1 + len(p)]
                if len(w) == len(p) and sum(x != y or x not in "ACGT" for x, y in zip(w, p)) <= mismatches:
                    out.add((read, ref, kind))
    return out


@pytest.mark.parametrize(("n", "mismatches", "tolerance"), [(15, 2, 1), (16, 3, 2), (37, 4, 3), (12, 5, 0)])
def test_long_patterns(spark, n, mismatches, tolerance):
    """Patterns of one number and of several, in reads of several chunks that hold letters other than ACGT."""
    rng = random.Random(n)
    patterns, reads = [], []
    for ref in range(6):
        pattern = "".join(rng.choice("ACGT") for _ in range(n))
        patterns.append((ref, "bar", pattern, rng.choice([1, 2, 250, 300])))
    for read in range(60):
        s = [rng.choice("ACGTN") for _ in range(rng.choice([0, n - 1, n, 400]))]
        _, _, pattern, start = rng.choice(patterns)
        changed = list(pattern)
        for i in rng.sample(range(n), rng.randint(0, mismatches + 1)):
            changed[i] = rng.choice("ACGTN")
        at = start - 1 + rng.randint(-tolerance, tolerance + 1)
        if 0 <= at <= len(s) - n:
            s[at : at + n] = changed
        reads.append((read, "".join(s)))
    df = spark.createDataFrame(reads, "read_id long, seq string")
    p = spark.createDataFrame(patterns, "ref long, kind string, pattern string, start int")
    got = {tuple(r) for r in dm.search(df, p, mismatches, tolerance).collect()}
    assert got == plain(reads, patterns, mismatches, tolerance)
    assert got


@pytest.mark.parametrize(("mismatches", "tolerance", "words"), [(2, 2, 1 << 15), (0, 0, 3), (5, 4, 3)])
def test_bits_against_hits(spark, monkeypatch, mismatches, tolerance, words):
    """Reads and references as bits give what listing all hits gives: several groups, odd letters, references without a second signature."""
    rng = random.Random(mismatches)
    pool = ["".join(rng.choice("ACGT") for _ in range(rng.choice([30, 48, 70, 130]))) for _ in range(12)]
    change = lambda s: "".join(rng.choice("ACGTN") if rng.random() < 0.05 else c for c in s)
    texts = [change(rng.choice(pool)) for _ in range(180)] + ["", "A"]
    reads = spark.createDataFrame([(k // 2 if k < 6 else k, s) for k, s in enumerate(texts)], "read_id long, seq string")
    rows = [(f"r{k}", s, rng.choice([1, 11]), 12, 25, 8 if k % 4 else 0) for k, s in enumerate(map(change, pool * 3))]
    library = spark.createDataFrame(rows, "ref string, seq string, barcode_start int, barcode_length int, secondary_start int, secondary_length int")
    patterns = dm.signatures(library)
    monkeypatch.setattr(dm, "GROUP", 70)
    monkeypatch.setattr(dm.barcode_bits, "WORDS", words)
    hits = dm.all_hits(reads, patterns, mismatches, tolerance).persist()
    flat = lambda df, *c: sorted(map(tuple, df.select(*c).collect()))
    pairs = dm.assigned(hits, patterns)
    assert flat(dm.assigned_pairs(reads, patterns, mismatches, tolerance), "read_id", "ref") == (want := flat(pairs, "read_id", "ref"))
    assert len(want) > 100
    mate = hits.selectExpr("*", "1 AS mate")
    assert flat(dm.assigned_once(reads, patterns, mismatches, tolerance), "read_id", "ref") == flat(dm.unambiguous(pairs.selectExpr("*", "1 AS mate")), "read_id", "ref")
    columns = ["ref", "init_barcode", "init_rev_barcode", "sec_hits", "rev_sec_hits", "unfiltered", "pre_union", "final_count", "reads_lost_to_filter", "lost_to_multihit"]
    assert flat(dm.report_one(reads, patterns, mismatches, tolerance), *columns) == flat(dm.report(mate, patterns), *columns)


def test_counts_in_bits_list_no_pairs(spark, monkeypatch):
    """Where pieces tell nothing, reads are counted without a row for each pair."""
    reads = [(k, "ACGTTGCAAC" * 4 + "ACGT"[k % 4] * 5) for k in range(40)]
    patterns = [(k, "rev_bar", "ACGTTGCAACGG", 1 + k % 3) for k in range(6)] + [(9, "rev_bar", "TTTTTTTTTTTT", 34)]
    df = spark.createDataFrame(reads, "read_id long, seq string")
    p = spark.createDataFrame(patterns, "ref long, kind string, pattern string, start int")
    found = plain(reads, patterns, 5, 4)
    want = {(r, "rev_bar", sum(ref == r for _, ref, _ in found)) for r in {ref for _, ref, _ in found}}
    monkeypatch.delattr(dm, "_matches")
    assert {tuple(r) for r in dm.counts(df, p, 5, 4).collect()} == want
