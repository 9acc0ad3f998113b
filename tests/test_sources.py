"""Files in and out."""

import gzip
import struct

import pytest
from pyspark.sql import functions as F

from chemprobe.sources import fasta, fastq, sam, tables, vectors


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">r1 words\nACGT\nAC\n>r2\nACGN\n>r1\nTTTT\n>\nACGT\n>r3\nGG\n")
    got = {r["ref"]: (r["seq"], r["length"]) for r in fasta.read_fasta(spark, f"{tmp_path}/a.fa").collect()}
    assert got == {"r1": ("ACGTAC", 6), "r3": ("GG", 2)}
    with pytest.raises(ValueError):
        fasta.write_fasta(spark.createDataFrame([("a", "AC"), ("a", "GG")], "ref string, seq string"), f"{tmp_path}/out")


def test_fasta_headers_with_the_sign(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">ref1 variant A>G here\nACGT\nAC\n>G\nTTTT\n>ref2 >x\r\nGG>\n>ref3\nA\n")
    (tmp_path / "b.fa").write_text(">ref4\nCC")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        got = {r["ref"]: r["seq"] for r in fasta.read_fasta(spark, f"{tmp_path}/*.fa").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {"ref1": "ACGTAC", "G": "TTTT", "ref3": "A", "ref4": "CC"}


def test_fastq(spark, tmp_path):
    text = "".join(f"@r{k} x\nACGT\n+\nFFFF\n" for k in range(3))
    (tmp_path / "s_R1.fastq").write_text(text + "@cut\nACG\n")
    with gzip.open(tmp_path / "s_R2.fastq.gz", "wt") as f:
        f.write(text)
    got = fastq.read_fastq(spark, str(tmp_path)).collect()
    assert sorted((r["read_id"], r["mate"], r["rec"]) for r in got) == sorted((f"r{k}", m, k) for k in range(3) for m in (1, 2))
    inter = fastq.read_fastq(spark, f"{tmp_path}/s_R1.fastq", interleaved=True)
    assert [r["mate"] for r in inter.orderBy("rec").collect()] == [1, 2, 1]
    units = fastq.find_units(spark, [str(tmp_path)]).collect()
    assert [(r["ref"], r["file1"].endswith("s_R1.fastq"), r["file2"].endswith("s_R2.fastq.gz")) for r in units] == [("s", True, True)]
    assert fastq.unmatched_ids(inter.where("rec = 0"), inter.where("rec = 1")).count() == 1


def test_fastq_in_blocks(spark, tmp_path):
    """Records that lie across blocks of any size, with qualities that look like heads, count on within their file."""
    reads = [(f"r{k}", "ACGT" * (k % 5), "@+F@" * (k % 5)) for k in range(9)]
    (tmp_path / "a_1.fq").write_text("".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in reads) + "@cut\nAC\n+")
    (tmp_path / "b_2.fq").write_text("".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in reads[:3]) + "@long\n" + "A" * 60 + "\n+\n" + "F" * 60)
    (tmp_path / "c.fq").write_text("@odd\nACGT\n+\nFFF\nno head\nA\n+\nF\n@e\n\n+\n\n")
    want = [("a_1.fq", k, *r, 1) for k, r in enumerate(reads)] + [("b_2.fq", k, *r, 2) for k, r in enumerate([*reads[:3], ("long", "A" * 60, "F" * 60)])] + [("c.fq", 2, "e", "", "", 0)]
    for size in ("9", "50", "1000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            found = fastq.read_fastq(spark, str(tmp_path))
            got = sorted((r["file"], r["rec"], r["read_id"], r["seq"], r["qual"], r["mate"]) for r in found.collect())
            tasks = found.rdd.getNumPartitions()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == want
        assert size == "1000" or tasks > 3  # a file is not read whole by one task


SAM = """@HD\tVN:1.6
q1\t0\tr\t1\t42\t4M\t*\t0\t0\tACGT\tIIII\tAS:i:10\tXS:i:-2
q2\t16\tr\t3\t1\t4M\t*\t0\t0\tACGT\tIII\tAS:i:5
short\tline
q3\t5000\tr\t3\t1\t4M\t*\t0\t0\tACGT\tIIII
"""


def test_sam(spark, tmp_path):
    (tmp_path / "x.sam").write_text(SAM)
    got = sam.read_sam(spark, f"{tmp_path}/x.sam").collect()
    assert [(r["qname"], r["pos"], r["as_score"], r["xs_score"]) for r in got] == [("q1", 1, 10, -2)]
    sam.write_sam(sam.read_sam(spark, f"{tmp_path}/x.sam"), f"{tmp_path}/out")
    assert sam.parse_sam(spark.read.text(f"{tmp_path}/out/*")).collect() == got


def test_sam_of_many_references(spark, tmp_path, monkeypatch):
    """Beyond the bound there is no folder for each reference, and every record is there."""
    names = "qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string"
    df = spark.createDataFrame([(f"q{k}", 0, f"r{k % 5}", k, 42, "2M", "AC", "FF") for k in range(1, 31)], names)
    for most, folders in ((5, 5), (4, 0)):
        monkeypatch.setattr(sam, "FOLDERS", most)
        sam.write_sam(df, f"{tmp_path}/{most}")
        assert len(list((tmp_path / str(most)).glob("rname=*"))) == folders
        got = sam.parse_sam(spark.read.text(f"{tmp_path}/{most}/*")).select(*df.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_vectors_of_many_references(spark, tmp_path, monkeypatch):
    rows = [(1, 3, f"q{k}", [1, 0, k % 9], None, f"r{k % 5}", "full") for k in range(30)]
    df = spark.createDataFrame(rows, "end5 int, end3 int, read string, vec array<smallint>, error string, rname string, section string")
    sections = df.select(F.col("rname").alias("ref"), "section")
    for most, folders in ((5, 5), (4, 0)):
        monkeypatch.setattr(vectors, "FOLDERS", most)
        for name, given in (("counted", None), ("given", sections)):
            vectors.write_vectors(df, f"{tmp_path}/{name}{most}", 3, sections=given)
            assert len(list((tmp_path / f"{name}{most}").glob("rname=*"))) == folders
            got = vectors.read_vectors(spark, f"{tmp_path}/{name}{most}")
            assert got.columns == df.columns and sorted(got.collect(), key=lambda r: r["read"]) == sorted(df.collect(), key=lambda r: r["read"])


def test_bam(spark, tmp_path):
    name, seq, qual = b"q1\0", "ACGTA", bytes([40] * 5)
    packed = bytes((("=ACMGRSVTWYHKDBN".index(a) << 4) | "=ACMGRSVTWYHKDBN".index(b)) for a, b in zip("AGA", "CT="))
    body = struct.pack("<iiBBHHHiiii", 0, 6, len(name), 42, 0, 1, 16, 5, -1, -1, 0) + name + struct.pack("<I", 5 << 4) + packed + qual + b"ASc" + struct.pack("<b", 9) + b"XXZhi\0" + b"XSC" + struct.pack("<B", 3)
    head = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 2) + b"r\0" + struct.pack("<i", 100)
    with gzip.open(tmp_path / "x.bam", "wb") as f:
        f.write(head + struct.pack("<i", len(body)) + body)
    r = sam.read_bam(spark, f"{tmp_path}/x.bam").first()
    assert (r["qname"], r["flag"], r["rname"], r["pos"], r["cigar"], r["seq"], r["qual"], r["as_score"], r["xs_score"]) == ("q1", 16, "r", 7, "5M", seq, "I" * 5, 9, 3)


def test_wide_vectors(spark, tmp_path):
    rows = spark.createDataFrame([("q1", 1, -128), ("q2", -31, 0)], f"{vectors.INDEX} string, C36 tinyint, A37 tinyint")
    rows.write.orc(f"{tmp_path}/v")
    got = {(r["read"], r["pos"]): (r["base"], r["b"]) for r in vectors.read_wide_vectors(spark, f"{tmp_path}/v").collect()}
    assert got == {("q1", 36): ("C", 1), ("q1", 37): ("A", 128), ("q2", 36): ("C", 225), ("q2", 37): ("A", 0)}
    assert vectors.read_wide_vectors(spark, f"{tmp_path}/v", [37]).select("pos").distinct().count() == 1
    assert vectors.batch_rows(1 << 20) == 32 and vectors.batch_rows(10**9) == 1


def test_checksums(spark, tmp_path):
    import hashlib

    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "0.orc").write_bytes(b"abc")
    good = hashlib.md5(b"abc").hexdigest()
    assert vectors.bad_batches(spark, f"{tmp_path}/b", [good]).count() == 0
    assert {r["problem"] for r in vectors.bad_batches(spark, f"{tmp_path}/b", ["0" * 32]).collect()} == {"missing", "not listed"}


def test_tables(spark, tmp_path):
    (tmp_path / "lib.csv").write_text("reference,section_start,section_end,family\nr1,1,20,f\nr2,,x,g\n")
    got = tables.read_table(spark, f"{tmp_path}/lib.csv").orderBy("reference").collect()
    assert [(r["section_start"], r["section_end"], r["family"]) for r in got] == [(1, 20, "f"), (None, None, "g")]
    m = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 2, 1, 0.25), ("a", 2, 2, 0.75)], "read string, k int, i int, p double")
    tables.write_membership(m, f"{tmp_path}/m.csv")
    assert sorted(map(tuple, tables.read_membership(spark, f"{tmp_path}/m.csv").collect())) == sorted(map(tuple, m.collect()))
    with pytest.raises(ValueError):
        tables.read_membership(spark, "m.xlsx")


def test_streaming_counts(spark, tmp_path):
    from chemprobe.streaming import counts

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.sam").write_text("q1\t0\tr\t1\t42\t4M\t*\t0\t0\tACGA\tIIII\n")
    (tmp_path / "in" / "b.sam").write_text("q2\t0\tr\t1\t42\t4M\t*\t0\t0\tACGT\tIIII\n")
    sections = spark.createDataFrame([("r", "full", 1, 4, "ACGT")], "ref string, section string, end5 int, end3 int, section_seq string")
    q = counts.stream_lines(spark, f"{tmp_path}/in").writeStream.foreachBatch(counts.add_batch(f"{tmp_path}/sum", sections)).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["pos"]: (r["cov"], r["sub_A"]) for r in counts.total(spark, f"{tmp_path}/sum").collect()}
    assert got == {1: (2, 0), 2: (2, 0), 3: (2, 0), 4: (2, 1)}
