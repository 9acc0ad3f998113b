"""Queries over the tables read every row and the whole of each text: brute force on a small fixture."""

from itertools import zip_longest

import pytest

from chemprobe.operators.align import TrimOptions
from chemprobe.plans import catalogue, procedures
from chemprobe.plans.views import BASES, LETTERS

TEXTS = {0: "Short text.", 1: "Word and more words, " * 40, 2: "Word and other words! " * 45, 3: "Tail. " * 30, 4: ""}
PASSAGES = {0: "A passage of some length, " * 20, 1: "Tiny passage"}
TURN = str.maketrans("ACGT", "TGCA")


def bases(text):
    return "".join(BASES[LETTERS.index(c)] for c in text.upper() if c in LETTERS)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(PASSAGES.items()), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows(spark, sf, name, *columns):
    return sorted(tuple(r) for r in catalogue.QUERIES[name](spark, sf).select(*columns).collect())


def test_reads_are_whole(spark, sf):
    assert rows(spark, sf, "revcomp", "read_id", "rc") == [(k, bases(t)[::-1].translate(TURN)) for k, t in TEXTS.items()]
    assert rows(spark, sf, "transcribe", "read_id", "dna") == [(k, bases(t)) for k, t in TEXTS.items()]
    n = [len(bases(t)) for t in TEXTS.values()]
    assert rows(spark, sf, "quality_report", "pos", "n") == [(i, sum(i <= x for x in n)) for i in range(1, max(n) + 1)]


def test_references_are_whole(spark, sf):
    assert rows(spark, sf, "fasta_first_wins", "ref", "seq") == [(f"r{k}", bases(t)) for k, t in PASSAGES.items()]


def test_fastq_keeps_every_read(spark, sf):
    assert rows(spark, sf, "fastq_round_trip", "read_id", "seq") == [(f"d{k}", bases(t)) for k, t in TEXTS.items()]


def test_every_read_is_vectorised(spark, sf):
    whole = {f"d{k}": len(bases(t)) for k, t in TEXTS.items() if t}
    assert rows(spark, sf, "sam_round_trip", "qname") == [(q,) for q in sorted(whole)]
    got = catalogue.QUERIES["vectorize_reads"](spark, sf).collect()
    assert {r["read"]: (len(r["vec"]), r["error"]) for r in got} == {q: (n, None) for q, n in whole.items()}
    cov = {r["pos"]: r["cov"] for r in catalogue.QUERIES["vector_profile"](spark, sf).collect()}
    assert cov == {i: sum(i <= n for n in whole.values()) for i in range(1, max(whole.values()) + 1)}


def test_indels_of_many_sizes(spark, tmp_path):
    text = "Enough letters for an indel of any size in these records."
    spark.createDataFrame([(k, text) for k in range(15)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    cigars = {r["cigar"] for r in procedures._records(spark, str(tmp_path)).select("cigar").collect()}
    n = len(bases(text))
    assert cigars == {f"{n}M"} | {f"20M{k}D{n - 20 - k}M" for k in range(2, 7)} | {f"20M{k}I{n - 20}M" for k in range(2, 7)}


def test_every_read_is_trimmed(spark, sf):
    got = {r["read_id"]: r["seq"] for r in catalogue.QUERIES["trim_reads"](spark, sf).collect()}
    # a poor end of five is cut from each read, and what is left of the adapter from the even ones
    for k, t in TEXTS.items():
        seq = (bases(t) + "AGATCGGAAGAGC" * (k % 2 == 0))[:-5]
        if len(seq) >= 20:
            assert got[str(k)] == seq[: adapter_by_hand(seq)]


def adapter_by_hand(seq, adapter="AGATCGGAAGAGC", o=TrimOptions()):
    for i in range(len(seq) - o.overlap + 1):
        pairs = list(zip(seq[i:], adapter))
        if sum(a != b for a, b in pairs) <= int(o.error * len(pairs)):
            return i
    return len(seq)


@pytest.mark.parametrize("name", ["em_cluster", "em_membership"])
def test_clustering_takes_the_operator_defaults(spark, monkeypatch, name):
    class Seen(Exception):
        pass

    def runs(patterns, positions, length, options):
        assert options == procedures.cl.Options() and (options.max_clusters, options.num_runs, options.min_iter, options.max_iter) == (3, 10, 100, 500)
        raise Seen

    monkeypatch.setattr(procedures.cl, "runs", runs)
    with pytest.raises(Seen):
        catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")


def test_sequences_are_compared_to_their_ends(spark, sf):
    b = {k: bases(t) for k, t in TEXTS.items()}
    apart = {k: [i + 1 for i, (x, y) in enumerate(zip_longest(b[k], b[k + 1])) if x != y] for k in range(4)}
    assert rows(spark, sf, "hamming_pairs", "a", "b", "d") == [(k, k + 1, len(apart[k])) for k in range(4)]
    assert rows(spark, sf, "diff_positions", "read_id", "pos") == [(k, i) for k in range(4) for i in apart[k]]
    low = dict(zip("ACGT", (225, 209, 177, 113)))
    good = dict(zip("ACGT", (16, 32, 64, 128)))
    want = [(k, [low[x] for x in s[:-1]], [1 if x == y else good[y] for x, y in zip(s, s[1:])]) for k, s in b.items()]
    assert rows(spark, sf, "base_bytes", "read_id", "low", "good") == want
    assert rows(spark, sf, "fold_sequences", "sequence") == sorted((bases(t),) for t in PASSAGES.values())


def test_whole_texts_are_validated(spark, tmp_path):
    texts = ["ACTs of parliament", "acgt" * 50, "ACGU" * 50, "ACGT\n", ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(spark, str(tmp_path), "seq_validate", "doc_id", "dna", "rna")
    assert got == [(0, False, False), (1, True, False), (2, False, True), (3, False, False), (4, False, False)]


def test_the_library_is_every_read(spark, sf):
    long = [k for k, t in TEXTS.items() if len(bases(t)) >= 48]
    assert len(long) == 3
    bars = {k: bases(TEXTS[k])[20:32] for k in long}
    want = {k: sum(bases(TEXTS[r])[20:32] == bars[k] or bases(TEXTS[r])[21:33] == bars[k] for r in TEXTS) for k in long}
    assert dict(rows(spark, sf, "demux_exact", "ref", "n_reads")) == want


def test_all_parts_are_checked(spark, tmp_path):
    parts = [(k, k % 50 + 1, "b") for k in range(1, 1001)]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    want = [(f"p{k}", "not in the references") for k, _, _ in parts if k % 20 == 0] + [(f"p{k}", "outside the reference") for k, n, _ in parts if k % 20 and n > 40]
    assert rows(spark, str(tmp_path), "library_checks", "reference", "problem") == sorted(want)
