"""How the driver's tables stand in for sequencing data, in Spark and as SQL with the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASES = ("ACGT" * 7)[:26]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vec(spark: SparkSession, sf: str, extra: str | None = None) -> DataFrame:
    """Long vectors: one read per order, one position per line number."""
    li = table(spark, sf, "lineitem")
    raw = ((F.col("l_partkey") * 31 + F.col("l_suppkey") * 7) % 256).cast("int")
    rows = li.select(F.col("l_orderkey").alias("read"), F.col("l_linenumber").alias("pos"), raw.alias("b"), *([F.expr(extra)] if extra else []))
    keys = [c for c in rows.columns if c != "b"]
    out = rows.groupBy(*keys).agg(F.bit_or("b").alias("b"))
    return out.withColumn("base", F.expr("substr('ACGT', pos % 4 + 1, 1)"))


def vec_sql(extra: str = "", name: str = "vec") -> str:
    more, group = (f", {extra}", ", 3") if extra else ("", "")
    return (
        f"{name} AS (SELECT *, substr('ACGT', pos % 4 + 1, 1) AS base FROM (SELECT l_orderkey AS read, l_linenumber AS pos{more}, "
        f"bit_or(CAST((l_partkey * 31 + l_suppkey * 7) % 256 AS INTEGER)) AS b FROM lineitem GROUP BY 1, 2{group}) q)"
    )


def as_bases(text: Column) -> Column:
    """Every letter of a text as a base."""
    return F.translate(F.upper(F.regexp_replace(text, "[^A-Za-z]", "")), LETTERS, BASES)


def as_bases_sql(text: str) -> str:
    return f"translate(upper(regexp_replace({text}, '[^A-Za-z]', '', 'g')), '{LETTERS}', '{BASES}')"


def reads(spark: SparkSession, sf: str) -> DataFrame:
    """Reads (read_id, seq): every document's whole text."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("read_id"), as_bases(F.col("text")).alias("seq"))


READS = f"reads AS (SELECT doc_id AS read_id, {as_bases_sql('text')} AS seq FROM documents)"


def refs(spark: SparkSession, sf: str) -> DataFrame:
    """References (ref, seq): every benchmark passage, whole."""
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("ref"), as_bases(F.col("text")).alias("seq"))


REFS = f"refs AS (SELECT item_id AS ref, {as_bases_sql('text')} AS seq FROM benchmark)"


def barcodes(r: DataFrame) -> DataFrame:
    """A library whose barcodes (12 bases from 21) and second signatures (8 bases from 41) are the reads' own; all that reach so far."""
    return r.where("length(seq) >= 48").select(
        F.col("read_id").alias("ref"), "seq", F.lit(21).alias("barcode_start"), F.lit(12).alias("barcode_length"), F.lit(41).alias("secondary_start"), F.lit(8).alias("secondary_length")
    )


BARCODES = READS + (
    ", bars AS (SELECT read_id AS ref, seq, length(seq) AS n, substr(seq, 21, 12) AS bar, substr(seq, 41, 8) AS sec FROM reads WHERE length(seq) >= 48)"
    ", rc AS (SELECT *, translate(reverse(bar), 'ACGT', 'TGCA') AS rbar, translate(reverse(sec), 'ACGT', 'TGCA') AS rsec FROM bars)"
)


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """A study: vectors split to samples s0-s2 and references r0-r3, s2 without r3."""
    from chemprobe.operators.profile import packed, profile_by_pos

    v = vec(spark, sf).withColumns({"sample": F.expr("concat('s', read % 3)"), "reference": F.expr("concat('r', read % 4)")}).where("NOT (read % 3 = 2 AND read % 4 = 3)")
    keys = ["sample", "reference"]
    rows = packed(profile_by_pos(v, keys), keys)
    reads_ = v.select(*keys, "read").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("num_aligned"))
    rows = rows.join(reads_, keys).withColumn("min_cov", F.array_min("cov")).withColumn("section", F.lit("full")).withColumn("cluster", F.lit("pop_avg"))
    rows = rows.withColumn("sequence", F.array_join(F.transform("pos", lambda p: F.substring(F.lit("ACGT"), p % 4 + 1, F.lit(1))), "")).drop("pos")
    return rows.withColumn("structure", F.lit("((...))")).withColumn("deltaG", -(F.expr("cast(substr(reference, 2) as int)") + 0.5))


PROFILE_COUNTS = (
    "sum(CASE WHEN b <> 0 THEN 1 ELSE 0 END)::BIGINT AS cov, sum(CASE WHEN b <> 0 AND (b | 5) = 5 THEN 1 ELSE 0 END)::BIGINT AS match, "
    + ", ".join(f"sum(CASE WHEN b = {c} THEN 1 ELSE 0 END)::BIGINT AS sub_{x}" for x, c in zip("ACGT", (16, 32, 64, 128)))
    + ", sum(CASE WHEN b <> 0 AND (b | 240) = 240 THEN 1 ELSE 0 END)::BIGINT AS sub_N, sum(CASE WHEN b = 2 THEN 1 ELSE 0 END)::BIGINT AS del, "
    "sum(CASE WHEN (b & 8) = 8 THEN 1 ELSE 0 END)::BIGINT AS ins"
)

#: The study at one row per position: sample, reference, pos, base, paired and the counters.
PROFILES = (
    vec_sql()
    + ", v AS (SELECT *, concat('s', read % 3) AS sample, concat('r', read % 4) AS reference FROM vec WHERE NOT (read % 3 = 2 AND read % 4 = 3))"
    + f", prof AS (SELECT *, match + sub_N AS info, CASE WHEN match + sub_N > 0 THEN sub_N / CAST(match + sub_N AS DOUBLE) END AS sub_rate, substr('((...))', pos, 1) IN ('(', ')') AS paired FROM (SELECT sample, reference, pos, base, {PROFILE_COUNTS} FROM v GROUP BY 1, 2, 3, 4) q)"
    + ", tops AS (SELECT sample, reference, min(cov) AS min_cov FROM prof GROUP BY 1, 2)"
    + ", aligned AS (SELECT sample, reference, count(DISTINCT read) AS num_aligned FROM v GROUP BY 1, 2)"
)
