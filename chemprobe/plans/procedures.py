"""Queries of operators that SQL cannot express: files, vectors of reads, clustering, alignment, folding.

Each makes its own small files or records from the tables, under the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.operators import align as al
from chemprobe.operators import cluster as cl
from chemprobe.operators import fold as fo
from chemprobe.operators import preprocess as pre
from chemprobe.operators import profile as prof
from chemprobe.operators import vectorize as ve
from chemprobe.plans.views import READS, REFS, reads, refs, vec
from chemprobe.runtime import shared_folder as _folder
from chemprobe.sources import fasta, fastq, sam, tables, vectors

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("fasta_first_wins", f"WITH {REFS} SELECT concat('r', ref) AS ref, seq, CAST(length(seq) AS INTEGER) AS length FROM refs")
def fasta_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    """References written twice over, the second time reversed, and read: the first of a name stays."""
    path, r = _folder(spark, "fasta"), refs(spark, sf).select(F.concat(F.lit("r"), "ref").alias("ref"), "seq")
    fasta.write_fasta(r, f"{path}/a")
    fasta.write_fasta(r.withColumn("seq", F.reverse("seq")), f"{path}/b")
    return fasta.read_fasta(spark, f"{path}/*")


@query("fastq_round_trip", f"WITH {READS} SELECT concat('d', read_id) AS read_id, seq, repeat('F', length(seq)) AS qual FROM reads")
def fastq_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "fastq")
    r = reads(spark, sf).select(F.lit("x").alias("ref"), F.lit(1).alias("mate"), F.concat(F.lit("d"), "read_id").alias("read_id"), "seq", F.expr("repeat('F', length(seq))").alias("qual"))
    fastq.write_demultiplexed(r, path)
    return fastq.read_fastq(spark, f"{path}/ref=x/mate=1").select("read_id", "seq", "qual")


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Records of reads against themselves as references, with a substitution, or a deletion or insertion of 2 to 6 bases.

    Reads too short for that match throughout; those without bases have no record.
    """
    r = reads(spark, sf).where("length(seq) > 0")
    n = F.length("seq")
    turn = "translate(substr(seq, 21, 1), 'ACGT', 'CGTA')"
    r = r.withColumn("kind", F.expr("if(length(seq) < 40, 3, cast(read_id % 3 as int))")).withColumn("size", F.expr("cast(read_id div 3 % 5 + 2 as int)"))
    r = r.withColumn("s", F.expr(f"case kind when 0 then concat(substr(seq, 1, 20), {turn}, substr(seq, 22)) when 1 then concat(substr(seq, 1, 20), substr(seq, 21 + size)) when 2 then concat(substr(seq, 1, 20), repeat('G', size), substr(seq, 21)) else seq end"))
    cigar = F.expr("case kind when 1 then concat('20M', size, 'D', length(seq) - 20 - size, 'M') when 2 then concat('20M', size, 'I', length(seq) - 20, 'M') else concat(length(seq), 'M') end")
    return r.select(
        F.concat(F.lit("d"), "read_id").alias("qname"), F.lit(0).alias("flag"), F.concat(F.lit("r"), "read_id").alias("rname"), F.lit(1).alias("pos"), F.lit(42).alias("mapq"),
        cigar.alias("cigar"), F.lit("*").alias("rnext"), F.lit(0).alias("pnext"), F.lit(0).alias("tlen"), F.col("s").alias("seq"), F.expr("repeat('F', length(s))").alias("qual"),
        n.alias("as_score"), F.lit(None).cast("int").alias("xs_score"), F.col("seq").alias("ref_seq"),
    )


def _sections_of(records: DataFrame) -> DataFrame:
    return records.select(F.col("rname").alias("ref"), F.lit("full").alias("section"), F.lit(1).alias("end5"), F.length("ref_seq").alias("end3"), F.col("ref_seq").alias("section_seq"))


@query(
    "sam_round_trip",
    f"WITH {READS}, k AS (SELECT *, CASE WHEN length(seq) < 40 THEN 3 ELSE read_id % 3 END AS kind, read_id // 3 % 5 + 2 AS size FROM reads WHERE length(seq) > 0), "
    "m AS (SELECT *, CASE kind WHEN 0 THEN concat(substr(seq, 1, 20), translate(substr(seq, 21, 1), 'ACGT', 'CGTA'), substr(seq, 22)) WHEN 1 THEN concat(substr(seq, 1, 20), substr(seq, 21 + size)) "
    "WHEN 2 THEN concat(substr(seq, 1, 20), repeat('G', size), substr(seq, 21)) ELSE seq END AS s, "
    "CASE kind WHEN 1 THEN concat('20M', size, 'D', length(seq) - 20 - size, 'M') WHEN 2 THEN concat('20M', size, 'I', length(seq) - 20, 'M') ELSE concat(length(seq), 'M') END AS cigar FROM k) "
    "SELECT concat('d', read_id) AS qname, CAST(0 AS INTEGER) AS flag, concat('r', read_id) AS rname, CAST(1 AS INTEGER) AS pos, CAST(42 AS INTEGER) AS mapq, cigar, '*' AS rnext, CAST(0 AS INTEGER) AS pnext, "
    "CAST(0 AS INTEGER) AS tlen, s AS seq, repeat('F', length(s)) AS qual, CAST(length(seq) AS INTEGER) AS as_score, CAST(NULL AS INTEGER) AS xs_score FROM m",
)
def sam_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "sam")
    sam.write_sam(_records(spark, sf).drop("ref_seq"), path)
    return sam.parse_sam(spark.read.text(f"{path}/*"))


@query("vectorize_reads")
def vectorize_reads(spark: SparkSession, sf: str) -> DataFrame:
    r = _records(spark, sf)
    return ve.vectorize(r.drop("ref_seq"), _sections_of(r))


@query("vector_profile")
def vector_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors through ORC files to a profile."""
    r, path = _records(spark, sf), _folder(spark, "vectors")
    vectors.write_vectors(ve.vectorize(r.drop("ref_seq"), _sections_of(r)), path, 60, sections=_sections_of(r))
    return prof.array_profile(vectors.read_vectors(spark, path), ["section"])


@query("vector_report")
def vector_report(spark: SparkSession, sf: str) -> DataFrame:
    r = _records(spark, sf)
    return vectors.report(ve.vectorize(r.drop("ref_seq"), _sections_of(r)), "2020-01-01 00:00:00.000000", "2020-01-01 00:00:10.500000", ["a", "b"])


_OPTIONS = cl.Options()


def _patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Reads that cover all seven positions, without close mutations, as patterns."""
    v = vec(spark, sf)
    whole = v.groupBy("read").agg(F.count(F.lit(1)).alias("n")).where("n = 7").select("read")
    used = v.join(whole, "read", "left_semi")
    used = used.join(pre.crowded_reads(used), "read", "left_anti")
    cells = F.array_sort(F.collect_list(F.struct("pos", F.when(pre.mutated(), "1").otherwise("0").alias("x"))))
    return used.groupBy("read").agg(F.array_join(F.transform(cells, lambda c: c["x"]), "").alias("pattern"))


@query("em_cluster")
def em_cluster(spark: SparkSession, sf: str) -> DataFrame:
    p = _patterns(spark, sf).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    return cl.best(cl.runs(p, list(range(7)), 7, _OPTIONS))


@query("em_membership")
def em_membership(spark: SparkSession, sf: str) -> DataFrame:
    r = _patterns(spark, sf)
    found = cl.runs(r.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), list(range(7)), 7, _OPTIONS)
    return cl.membership(r, found, list(range(7)))


def _fastq(spark: SparkSession, sf: str) -> DataFrame:
    """Reads with a poor end, every second one with an adapter after it."""
    r = reads(spark, sf).withColumn("seq", F.expr("if(read_id % 2 = 0, concat(seq, 'AGATCGGAAGAGC'), seq)"))
    qual = F.expr("concat(repeat('F', length(seq) - 5), repeat('#', least(length(seq), 5)))")
    return r.select(F.col("read_id").cast("string").alias("read_id"), F.lit(0).alias("mate"), "seq", qual.alias("qual"))


@query("trim_reads")
def trim_reads(spark: SparkSession, sf: str) -> DataFrame:
    return al.trim(_fastq(spark, sf))


@query("quality_report", f"WITH {READS}, q AS (SELECT seq FROM reads) SELECT CAST(0 AS INTEGER) AS mate, CAST(i AS INTEGER) AS pos, count(*) AS n, count(CASE WHEN substr(seq, i, 1) = 'A' THEN 1 END) AS \"n_A\" FROM q, (SELECT unnest(range(1, (SELECT max(length(seq)) FROM reads) + 1)) AS i) t WHERE i <= length(seq) GROUP BY 2")
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    r = reads(spark, sf).select(F.lit(0).alias("mate"), "seq", F.expr("repeat('F', length(seq))").alias("qual"))
    return al.quality_report(r).select("mate", F.col("pos").cast("int").alias("pos"), "n", "n_A")


@query("align_reads")
def align_reads(spark: SparkSession, sf: str) -> DataFrame:
    r = refs(spark, sf).select(F.concat(F.lit("r"), "ref").alias("ref"), "seq")
    pieces = r.select(F.concat(F.lit("q"), "ref").alias("read_id"), F.lit(0).alias("mate"), F.expr("substr(seq, 11, 50)").alias("seq")).withColumn("qual", F.expr("repeat('F', length(seq))"))
    return al.align(pieces, r)


@query("fold_sequences")
def fold_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return fo.structures(refs(spark, sf).select(F.col("seq").alias("sequence")))


@query("membership_round_trip")
def membership_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "membership") + ".csv"
    tables.write_membership(em_membership(spark, sf), path)
    return tables.read_membership(spark, path)
