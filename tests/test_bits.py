"""All 256 x 256 pairs of query and byte, for the four modes, against sets of bits."""

import pytest
from pyspark.sql import functions as F

from chemprobe.functions.bits import consensus, mut_match, rendered, unsigned


def bits(x):
    return {k for k in range(8) if x >> k & 1}


@pytest.mark.parametrize("subsets,supersets", [(False, False), (True, False), (False, True), (True, True)])
def test_every_pair(spark, subsets, supersets):
    b = F.col("b")
    df = spark.range(256).select(F.col("id").cast("int").alias("b"))
    got = df.select("b", F.array(*[mut_match(b, q, subsets, supersets) for q in range(256)]).alias("m")).collect()
    for r in got:
        for q, m in enumerate(r["m"]):
            within, around = bits(r["b"]) <= bits(q), bits(r["b"]) >= bits(q)
            want = r["b"] != 0 and ((subsets and within) or (supersets and around) or (not subsets and not supersets and within and around))
            assert m == want, (r["b"], q)


def test_odd_queries():
    for q in (-1, 256):
        with pytest.raises(ValueError):
            mut_match(F.col("b"), q)
    for q in (1.0, "1", True):
        with pytest.raises(TypeError):
            mut_match(F.col("b"), q)


def test_consensus_and_signs(spark):
    rows = spark.createDataFrame([(1, 1), (1, 16), (17, 16), (0, 2), (0, 0)], "a int, b int").select(consensus(F.col("a"), F.col("b")).alias("c")).collect()
    assert [r["c"] for r in rows] == [1, 17, 16, 2, 0]
    rows = spark.createDataFrame([(-128,), (-31,), (5,)], "b tinyint").select(unsigned(F.col("b")).alias("u")).collect()
    assert [r["u"] for r in rows] == [128, 225, 5]
    line = spark.createDataFrame([([0, 1, 2, 16, 128, 3, 240],)], "v array<int>").select(rendered(F.col("v")).alias("l")).first()["l"]
    assert line == ".~/AT??"
