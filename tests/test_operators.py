"""Sections, barcodes, alignment, folding, studies and metadata on small cases."""

import pytest
from pyspark.sql import functions as F

from chemprobe.functions import sequences as seq
from chemprobe.functions import stats
from chemprobe.operators import aggregate as agg
from chemprobe.operators import align as al
from chemprobe.operators import demultiplex as dm
from chemprobe.operators import fold as fo
from chemprobe.operators import reads as rd
from chemprobe.operators import sections as sec
from chemprobe.operators import study as st


def test_sections(spark):
    refs = spark.createDataFrame([("a", "AACCGGTTAACCAGTT"), ("b", "ACGTACGTAC")], "ref string, seq string")
    specs = spark.createDataFrame(
        [("a", 3, -2, None, None, None), ("a", None, None, "AACCGG", None, "p"), ("a", 9, 3, None, None, None), ("a", None, None, "TTTT", None, "lost"), ("a", 3, 15, None, None, "again")],
        "ref string, end5 int, end3 int, fwd string, rev string, section string",
    )
    got = {(r["ref"], r["end5"], r["end3"]): (r["valid"], r["section_seq"]) for r in sec.sections(refs, specs).collect()}
    assert got[("a", 3, 15)] == (True, "CCGGTTAACCAGT")
    assert got[("a", 9, 16)][0] and got[("b", 1, 10)] == (True, "ACGTACGTAC")
    assert got[("a", 9, 3)] == (False, None) and got[("a", 1, 16)][0] is False


def test_sequences(spark):
    df = spark.createDataFrame([("ACGTN", "ACGTTACG", "inst:1:c:4:5:6:7 x", "3=1X2I")], "s string, t string, name string, cigar string")
    r = df.select(
        seq.reverse_complement(F.col("s")).alias("rc"), seq.locate_primer(F.col("t"), F.lit("GTT")).alias("p"), seq.locate_primer(F.col("t"), F.lit("ACG")).alias("two"),
        seq.illumina_key(F.col("name")).alias("k"), seq.cigar_consumed(F.col("cigar"), "M=XD").alias("ref"), seq.cigar_consumed(F.col("cigar"), "M=XIS").alias("read"),
        seq.hamming(F.col("s"), F.col("t")).alias("h"), seq.found_within(F.col("t"), "TTAG", 2, 8, 1).alias("f"), seq.found_within(F.col("t"), "TTAG", 2, 8, 0).alias("g"),
    ).first()
    assert (r["rc"], tuple(r["p"]), r["two"], r["k"], r["ref"], r["read"], r["h"], r["f"], r["g"]) == ("NACGT", (3, 5), None, "5:6:7", 4, 6, None, True, False)


def test_demultiplex(spark):
    base = {"r1": "ACGTTGCAAC" + "GGATCCGATACA" + "TTGACCGTAGGATC", "r2": "TTGCAACGTA" + "CATGAAGTCTAG" + "GACTTACCGATTGA"}
    lib = spark.createDataFrame([(k, v, 11, 12, 0, 0) for k, v in base.items()], "ref string, seq string, barcode_start int, barcode_length int, secondary_start int, secondary_length int")
    one = base["r1"]
    rows = [("exact", 1, one), ("miss", 1, one[:13] + "A" + one[14:]), ("shift", 1, "GG" + one), ("rev", 2, one[::-1].translate(str.maketrans("ACGT", "TGCA"))), ("other", 1, base["r2"]), ("none", 1, "A" * 36), ("short", 1, "ACG")]
    rows += [("two", 1, one), ("two", 2, base["r2"])]
    reads = spark.createDataFrame(rows, "read_id string, mate int, seq string")
    got = {r["read_id"]: (r["ref"], r["found_by"]) for r in dm.demultiplex(reads, lib, mismatches=1, tolerance=2).collect()}
    assert got == {"exact": ("r1", "R1"), "miss": ("r1", "R1"), "shift": ("r1", "R1"), "rev": ("r1", "R2"), "other": ("r2", "R1")}
    strict = {r["read_id"] for r in dm.demultiplex(reads, lib).collect()}
    assert strict == {"exact", "rev", "other"}


def test_best_alignments(spark):
    rows = [("a", 10, None), ("b", 10, 9), ("b", 10, 10), ("c", 5, -3), ("d", None, 4)]
    sam = spark.createDataFrame(rows, "qname string, as_score int, xs_score int")
    assert sorted(r["qname"] for r in rd.best_alignments(sam, ["qname"]).collect()) == ["a", "c"]


def test_align_and_trim(spark):
    ref = "ACGTTGCAACGGATCCGATACATTGACCGTAGGATCCATGAAGTCTAGGACTTACCGATTGAGCTA"
    refs = spark.createDataFrame([("r", ref)], "ref string, seq string")
    changed = ref[5:25] + "A" + ref[26:45]
    gone = ref[5:25] + ref[28:50]
    turned = ref[10:45][::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("sub", changed), ("del", gone), ("rev", turned), ("none", "T" * 30)]
    reads = spark.createDataFrame([(k, 0, s, "F" * len(s)) for k, s in rows], "read_id string, mate int, seq string, qual string")
    got = {r["qname"]: r for r in al.align(reads, refs).collect()}
    assert got["sub"]["pos"] == 6 and got["sub"]["cigar"] == ("20=1X19=" if ref[25] != "A" else "40=")
    assert got["del"]["pos"] == 6 and seq_len(got["del"]["cigar"]) == (45, 42)
    assert got["rev"]["flag"] == 16 and got["rev"]["pos"] == 11 and got["rev"]["cigar"] == "35="
    assert "none" not in got
    pair = spark.createDataFrame(
        [("p", 1, ref[:40] + al.ADAPTER, "F" * 53), ("p", 2, ref[:30], "F" * 25 + "#" * 5), ("q", 1, ref[:40], "F" * 40), ("q", 2, ref[:30], "#" * 30)],
        "read_id string, mate int, seq string, qual string",
    )
    cut = {(r["read_id"], r["mate"]): r["seq"] for r in al.trim(pair).collect()}
    assert cut == {("p", 1): ref[:40], ("p", 2): ref[:25]}


def seq_len(cigar):
    from chemprobe.operators.vectorize import steps

    return sum(n for o, n in steps(cigar) if o in "M=XD"), sum(n for o, n in steps(cigar) if o in "M=XIS")


def test_fold():
    e, s = fo.fold("GGGGAAAACCCC")
    assert s == "((((....))))" and e < 0
    assert fo.fold("AAAAAAAA") == (0.0, "........") and fo.fold("") == (0.0, "")
    e, s = fo.fold("GGGAAACCCAAAGGGAAACCC")
    assert s.count("(") == s.count(")") and e < 0


def test_fold_ledger(spark):
    seqs = spark.createDataFrame([("GGGGAAAACCCC",), ("GGGGAAAACCCC",), (None,), ("AAAA",)], "sequence string")
    ledger = spark.createDataFrame([("AAAA", -9.0, "kept")], "sequence string, deltaG double, structure string")
    got = {r["sequence"]: r["structure"] for r in fo.structures(seqs, ledger=ledger).collect()}
    assert got == {"GGGGAAAACCCC": "((((....))))", "AAAA": "kept"}


def test_study(spark):
    row = ("s", "r", 3, "ACGA", "(..)", [10, 3, 20, 30], [0.1, None, 0.3, 0.4])
    df = spark.createDataFrame([row, ("t", "r", 30, *row[3:])], "sample string, reference string, min_cov int, sequence string, structure string, cov array<int>, sub_rate array<double>")
    s = st.Study(df)
    r = s.get_df(base_type="A", sample="s").first()
    assert r["index_selected"] == [1, 4] and r["cov"] == [10, 30] and r["sequence"] == "AA" and r["unique_id"] == ""
    assert s.get_df(base_index="CG").first()["cov"] == [3, 20] and s.get_df(base_index="A").count() == 0
    assert s.get_df(base_pairing=True, base_index=[1, 2]).first()["index_selected"] == [1]
    assert st.Study(df, min_cov=10).df.count() == 1
    assert {r["unique_id"] for r in s.get_df().collect()} == {"s", "t"}
    with pytest.raises(ValueError):
        s.get_df(nothing=1)
    df2 = df.withColumns({f"sub_{b}": F.col("cov") for b in "ACGTN"} | {"info": F.col("cov")})
    assert {k: t.count() for k, t in st.Study(df2).figure_tables().items()}["base_coverage"] == 8
    both = st.Study.of(df, df.withColumn("extra", F.lit(1)))
    assert both.df.count() == 4 and both.df.where("extra IS NULL").count() == 2


def test_metadata(spark):
    refs = spark.createDataFrame([("r1", "ACGTACGT"), ("r2", "ACGT")], "ref string, seq string")
    lib = spark.createDataFrame([("r1", 2, 5, None, "f"), ("r1", 2, 5, None, "f"), ("r2", None, None, None, "g"), ("r9", 5, 2, "x", "h")], "reference string, section_start int, section_end int, section string, family string")
    assert {(r["reference"], r["problem"]) for r in agg.library_problems(lib, refs).collect()} == {("r9", "not in the references"), ("r9", "starts after its end")}
    clean = {(r["reference"], r["section"]) for r in agg.clean_library(lib, refs).collect()}
    assert clean == {("r1", "2-5"), ("r1", "full"), ("r2", "full")}
    samples = spark.createDataFrame([("a", "u", "d", "in_vitro", 310, 1, "b", None), ("b", "u", "d", "in_vivo", 310, 1, None, None), ("b", "u", "d", "moon", 310, 1, None, None)], "sample string, user string, date string, exp_env string, temperature_k int, inc_time_tot_secs int, buffer string, cell_line string")
    assert {(r["sample"], r["problem"]) for r in agg.sample_problems(samples).collect()} == {("b", "no cell_line"), ("b", "exp_env"), ("b", "repeated")}
    with pytest.raises(ValueError):
        agg.with_sample(spark.createDataFrame([("b",)], "sample string"), samples)


def test_documents_do_not_leak_attributes(spark):
    text = '{"sample":"s","r1":{"a":"1","full":{"pop_avg":{"cov":[1,2]}}},"r2":{"full":{"pop_avg":{"cov":[3]}}}}'
    rows = {r["reference"]: r for r in agg.flatten_documents(spark.createDataFrame([(text,)], "document string")).collect()}
    assert rows["r1"]["reference_attributes"] == {"a": "1"} and rows["r2"]["reference_attributes"] == {}
    assert rows["r2"]["values"] == {"cov": "[3]"}


def test_fits():
    import numpy as np

    x = np.linspace(0.1, 5, 40)
    p, r2 = stats.nonlinear_fit(x, 3 * x / (0.7 + x), "saturation", [1, 1])
    assert np.allclose(p, [3, 0.7], atol=1e-4) and r2 > 0.999999
    with pytest.raises(KeyError):
        stats.nonlinear_fit(x, x, "__import__('os')", [1])
