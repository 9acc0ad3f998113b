"""Command line: `python -m chemprobe.cli STEP ...`, each step reading and writing files.

vectorize  SAM text and FASTA to vectors in ORC
aggregate  vectors, library and samples to one JSON document per sample
cluster    vectors of one section to memberships
demultiplex  FASTQ and library to FASTQ per reference
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.operators import aggregate, cluster, demultiplex, preprocess, profile, sections, vectorize
from chemprobe.session import get_session
from chemprobe.sources import fasta, fastq, sam, tables, vectors


def _sections(spark: SparkSession, refs: DataFrame, library: str | None) -> DataFrame:
    if library:
        lib = aggregate.clean_library(tables.read_table(spark, library), refs)
        specs = lib.select(F.col("reference").alias("ref"), F.col("section_start").alias("end5"), F.col("section_end").alias("end3"), "section")
    else:
        specs = refs.select("ref", F.lit(None).cast("int").alias("end5"), F.lit(None).cast("int").alias("end3"), F.lit(None).cast("string").alias("section"))
    specs = specs.withColumn("fwd", F.lit(None).cast("string")).withColumn("rev", F.lit(None).cast("string"))
    return sections.sections(refs, specs).where("valid")


def run_vectorize(spark: SparkSession, a: argparse.Namespace) -> None:
    refs = fasta.read_fasta(spark, a.fasta)
    sec = _sections(spark, refs, a.library)
    found = vectorize.vectorize(sam.read_sam(spark, a.sam), sec, a.min_phred + a.phred_enc, not a.no_ambid, a.strict)
    vectors.write_vectors(found, a.out, a.length, a.batch_size, sec)


def run_aggregate(spark: SparkSession, a: argparse.Namespace) -> None:
    refs = fasta.read_fasta(spark, a.fasta)
    sec = _sections(spark, refs, a.library)
    keys = ["rname", "section"]
    rows = profile.packed(profile.array_profile(vectors.read_vectors(spark, a.vectors), keys), keys)
    named = rows.join(sec.select(F.col("ref").alias("rname"), "section", F.col("section_seq").alias("sequence"), F.col("end5").alias("section_start"), F.col("end3").alias("section_end")), keys)
    named = named.withColumnRenamed("rname", "reference").withColumn("sample", F.lit(a.sample)).withColumn("cluster", F.lit("pop_avg")).withColumn("min_cov", F.array_min("cov")).drop("pos")
    own: list[str] = []
    if a.samples:
        table = tables.read_table(spark, a.samples)
        own = [c for c in table.columns if c != "sample"]
        named = aggregate.with_sample(named, table)
    extra: list[str] = []
    if a.library:
        table = tables.read_table(spark, a.library)
        extra = [c for c in table.columns if c not in ("reference", *aggregate.LIBRARY_PLACES)]
        named = aggregate.with_library(named, table)
    tables.write_documents(aggregate.sample_documents(named, own, extra, ["sequence", "section_start", "section_end"]), a.out)


def run_cluster(spark: SparkSession, a: argparse.Namespace) -> None:
    refs = fasta.read_fasta(spark, a.fasta)
    sec = _sections(spark, refs, a.library).where((F.col("ref") == a.ref) & (F.col("section") == a.section))
    length = sec.select(F.length("section_seq")).first()[0]
    first = sec.select("end5").first()[0]
    found = vectors.read_vectors(spark, a.vectors).where((F.col("rname") == a.ref) & (F.col("section") == a.section)).withColumn("error", F.lit(None))
    used = preprocess.preprocess(vectorize.long_form(found, sec), a.include_gu, a.include_del, a.signal_thresh)
    preprocess.enough_reads(used, a.min_reads)
    places = sorted(r["pos"] - first for r in used.select("pos").distinct().collect())  # at most the section's length
    cells = F.array_sort(F.collect_list(F.struct("pos", F.when(preprocess.mutated(a.include_del), "1").otherwise("0").alias("x"))))
    reads = used.groupBy("read").agg(F.array_join(F.transform(cells, lambda c: c["x"]), "").alias("pattern"))
    options = cluster.Options(max_clusters=a.max_clusters, num_runs=a.num_runs, seed=a.seed)
    runs = cluster.runs(reads.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), places, length, options)
    tables.write_membership(cluster.membership(reads, runs, places), a.out)


def run_demultiplex(spark: SparkSession, a: argparse.Namespace) -> None:
    refs = fasta.read_fasta(spark, a.fasta)
    lib = tables.read_table(spark, a.library).join(refs.select(F.col("ref").alias("reference"), "seq"), "reference")
    lib = lib.withColumnRenamed("reference", "ref")
    for c in ("secondary_signature_start", "secondary_signature_length"):
        lib = lib.withColumn(c.replace("_signature", ""), F.coalesce(F.col(c), F.lit(0)) if c in lib.columns else F.lit(0))
    reads = fastq.read_fastq(spark, a.fastq)
    found = demultiplex.demultiplex(reads, lib, a.mismatch_tolerance, a.index_tolerance, a.clipped)
    fastq.write_demultiplexed(reads.join(found.select("read_id", "ref"), "read_id"), a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chemprobe", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    steps = p.add_subparsers(dest="step", required=True)

    def step(name: str, run, *required: str) -> argparse.ArgumentParser:
        s = steps.add_parser(name)
        s.set_defaults(run=run)
        for r in (*required, "out"):
            s.add_argument(f"--{r}", required=True)
        return s

    s = step("vectorize", run_vectorize, "sam", "fasta")
    s.add_argument("--library")
    s.add_argument("--min-phred", type=int, default=25)
    s.add_argument("--phred-enc", type=int, default=33)
    s.add_argument("--batch-size", type=float, default=32.0)
    s.add_argument("--length", type=int, default=150, help="bases of a section, to size the batches")
    s.add_argument("--no-ambid", action="store_true")
    s.add_argument("--strict", action="store_true")
    s = step("aggregate", run_aggregate, "vectors", "fasta", "sample")
    s.add_argument("--library")
    s.add_argument("--samples")
    s = step("cluster", run_cluster, "vectors", "fasta", "ref", "section")
    s.add_argument("--library")
    for name, default in (("max-clusters", 3), ("num-runs", 10), ("min-reads", 1000), ("seed", 0)):
        s.add_argument(f"--{name}", type=int, default=default)
    s.add_argument("--signal-thresh", type=float, default=0.005)
    s.add_argument("--include-gu", action="store_true")
    s.add_argument("--include-del", action="store_true")
    s = step("demultiplex", run_demultiplex, "fastq", "fasta", "library")
    for name in ("clipped", "index-tolerance", "mismatch-tolerance"):
        s.add_argument(f"--{name}", type=int, default=0)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(get_session(), a)


if __name__ == "__main__":
    main()
