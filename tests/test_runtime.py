"""SQL functions, reports, listings, locks, paths and ensembles."""

import hashlib
import itertools
import logging
import math

import numpy as np
import pytest

from chemprobe.functions.bits import consensus, mut_match
from chemprobe.functions.register import register
from chemprobe.operators import ensemble
from chemprobe.operators.fold import LEAST_LOOP, LOOP, PAIR_ENERGY
from chemprobe.runtime import OutputLock, OutputPath, missing_programs, set_up_logging
from chemprobe.sources import reports, vectors


def test_sql_functions(spark):
    from pyspark.sql import functions as F

    names = register(spark)
    assert {"mut_match", "cigar_operations"} <= set(names)
    spark.range(256).selectExpr("cast(id as int) AS b").createOrReplaceTempView("every_byte")
    for query, sub, sup in itertools.product((0, 1, 16, 241, 255), (False, True), (False, True)):
        got = spark.sql(f"SELECT b, mut_match(b, {query}, {sub}, {sup}) AS m FROM every_byte ORDER BY b").collect()
        want = spark.table("every_byte").select("b", mut_match(F.col("b"), query, sub, sup).alias("m")).orderBy("b").collect()
        assert got == want, (query, sub, sup)
    two = spark.sql("SELECT mate_consensus(1, 17) AS a, mate_consensus(1, 16) AS b, reverse_complement('AACG') AS c, unsigned_byte(-128) AS d").first()
    assert tuple(two) == (1, 17, "CGTT", 128)
    assert [r[0] for r in spark.range(1).select(consensus(F.lit(1), F.lit(17))).collect()] == [1]
    spark.sql("SELECT 'r1' AS q, '3S10M2D5=' AS cigar UNION ALL SELECT 'r2', '7I'").createOrReplaceTempView("records")
    ops = spark.sql("SELECT q, o.place, o.op, o.length FROM records, LATERAL cigar_operations(cigar) o ORDER BY 1, 2").collect()
    assert [tuple(r) for r in ops] == [("r1", 0, "S", 3), ("r1", 1, "M", 10), ("r1", 2, "D", 2), ("r1", 3, "=", 5), ("r2", 0, "I", 7)]


def test_reports(spark, tmp_path):
    found = spark.createDataFrame([("a", None), ("b", None), ("c", "record")], "read string, error string")
    (tmp_path / "v").mkdir()
    sums = []
    for k in range(2):
        (tmp_path / "v" / f"{k}.orc").write_bytes(b"batch %d" % k)
        sums.append(hashlib.md5(b"batch %d" % k).hexdigest())
    report = vectors.report(found, "2020-01-01 00:00:00.000000", "2020-01-01 00:00:10.500000", sums)
    places = {"Sample": "s", "Section 5' End": 3}
    reports.write_report(report, f"{tmp_path}/report.json", places)
    got = reports.read_report(spark, f"{tmp_path}/report.json")
    assert got["Reads Vectorized"] == 2 and got["Reads with Errors"] == 1 and got["Checksums"] == sums and got["Section 5' End"] == 3
    assert (got["Ended"] - got["Began"]).total_seconds() == got["Time Taken"] == 10.5
    reports.check_report(spark, got, f"{tmp_path}/v", places)
    with pytest.raises(ValueError):
        reports.check_report(spark, got, f"{tmp_path}/v", {"Sample": "other"})
    (tmp_path / "v" / "1.orc").write_bytes(b"changed")
    with pytest.raises(ValueError):
        reports.check_report(spark, got, f"{tmp_path}/v")
    (tmp_path / "v" / "1.orc").unlink()
    with pytest.raises(FileNotFoundError):
        reports.check_report(spark, got, f"{tmp_path}/v")
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "r.json").write_text('{"Batches": "two"}')
    with pytest.raises(ValueError):
        reports.read_report(spark, f"{tmp_path}/odd")


def test_alignment_listing(tmp_path):
    for name in ("a.bam", "b.cram", "notes.txt"):
        (tmp_path / name).write_text("")
    assert [p.rsplit("/", 1)[1] for p in reports.list_alignments([str(tmp_path)])] == ["a.bam", "b.cram"]
    for paths, error in (([f"{tmp_path}/none.bam"], FileNotFoundError), ([f"{tmp_path}/notes.txt"], ValueError), ([str(tmp_path), f"{tmp_path}/a.bam"], ValueError)):
        with pytest.raises(error):
            reports.list_alignments(paths)


def test_feather(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import feather

    feather.write_feather(pa.table({"a": [1, 2], "b": ["x", None]}), f"{tmp_path}/t.feather")
    assert [tuple(r) for r in reports.read_feather(spark, f"{tmp_path}/t.feather").orderBy("a").collect()] == [(1, "x"), (2, None)]


def test_locks_keep_two_runs_apart(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    with pytest.raises(KeyError), OutputLock(spark, path):
        with pytest.raises(FileExistsError), OutputLock(spark, path):
            pass
        raise KeyError
    with OutputLock(spark, path):
        pass


def test_paths_and_logging(tmp_path):
    p = OutputPath("/top", "vectoring", "s1", "ref", 3, 40, "0.orc")
    assert str(p) == "/top/vectoring/s1/ref/3-40/0.orc" and OutputPath.parse("/top/", str(p)) == OutputPath("/top/", *[getattr(p, x) for x in ("step", "sample", "ref", "end5", "end3", "name")])
    assert OutputPath.parse("/top", "/top/vectoring/s1").ref is None
    for bad in ("/else/a/b", "/top/a", "/top/a/b/c/9-2/x", "/top/a/b/c/1-2/x/y"):
        with pytest.raises(ValueError):
            OutputPath.parse("/top", bad)
    with pytest.raises(ValueError):
        OutputPath("/top", "a", "s", None, 1, 2)
    assert missing_programs(["python", "no-such-program-anywhere"])[-1] == "no-such-program-anywhere"
    log = set_up_logging(quiet=2, file=f"{tmp_path}/log.txt")
    log.debug("kept")
    assert "kept" in (tmp_path / "log.txt").read_text() and log.handlers[0].level == logging.CRITICAL
    set_up_logging()


def nested(i, j):
    """All sets of nested pairs between places i and j."""
    if j - i <= LEAST_LOOP:
        yield ()
        return
    yield from nested(i, j - 1)
    for k in range(i, j - LEAST_LOOP):
        for a in nested(i, k - 1):
            for b in nested(k + 1, j - 1):
                yield (*a, *b, (k, j))


@pytest.mark.parametrize("seq", ["GGGAAACCC", "GCGAAAAGCGU", "ACGUACGUACGU", "AAAA", "", "GGGAAATCCACGT"])
def test_ensembles_by_enumeration(seq):
    s, rt = seq.replace("T", "U"), ensemble.GAS * 310.15
    total, seen = 0.0, np.zeros((len(s), len(s)))
    for pairs in nested(0, len(s) - 1):
        if any(s[i] + s[j] not in PAIR_ENERGY for i, j in pairs):
            continue
        inside = set(pairs)
        stacked = lambda i, j: (i + 1, j - 1) in inside and j - i > LEAST_LOOP + 2
        w = math.exp(-sum(PAIR_ENERGY[s[i] + s[j]] if stacked(i, j) else LOOP for i, j in pairs) / rt)
        total += w
        for i, j in pairs:
            seen[i, j] += w
            seen[j, i] += w
    energy, p = ensemble.pair_probabilities(seq)
    assert energy == pytest.approx(-rt * math.log(total), abs=1e-9) and np.allclose(p, seen / total)


def test_ensembles(spark):
    seqs = spark.createDataFrame([("GGGAAACCC",), ("GGGAAACCC",), (None,), ("",)], "sequence string")
    got = {r["sequence"]: r for r in ensemble.ensembles(seqs).collect()}
    assert set(got) == {"GGGAAACCC", ""} and len(got["GGGAAACCC"]["paired"]) == 9 and got[""]["pairs"] == []
    assert all(x["i"] < x["j"] and 0 < x["p"] <= 1 for x in got["GGGAAACCC"]["pairs"])
