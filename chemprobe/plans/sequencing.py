"""Queries over reads, references, sections and barcodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.functions import sequences as seq
from chemprobe.operators import demultiplex as dm
from chemprobe.operators import sections as sec
from chemprobe.plans.views import BARCODES, READS, REFS, barcodes, reads, refs, table
from chemprobe.runtime import stored

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("revcomp", f"WITH {READS} SELECT read_id, translate(reverse(seq), 'ACGT', 'TGCA') AS rc FROM reads")
def revcomp(spark: SparkSession, sf: str) -> DataFrame:
    return reads(spark, sf).select("read_id", seq.reverse_complement(F.col("seq")).alias("rc"))


@query("transcribe", f"WITH {READS} SELECT read_id, replace(seq, 'T', 'U') AS rna, seq AS dna FROM reads")
def transcribe(spark: SparkSession, sf: str) -> DataFrame:
    rna = reads(spark, sf).select("read_id", seq.transcribe(F.col("seq")).alias("rna"))
    return rna.withColumn("dna", seq.reverse_transcribe(F.col("rna")))


@query("seq_validate", "SELECT doc_id, regexp_full_match(upper(text), '[ACGT]+') AS dna, regexp_full_match(upper(text), '[ACGU]+') AS rna FROM documents")
def seq_validate(spark: SparkSession, sf: str) -> DataFrame:
    text = F.upper("text")
    return table(spark, sf, "documents").select("doc_id", seq.is_dna(text).alias("dna"), seq.is_rna(text).alias("rna"))


def _padded(x: str, y: str) -> Column:
    """Column `x`, as long as the longer of the two, so that what one has more differs."""
    return F.expr(f"rpad({x}, greatest(length({x}), length({y})), '-')")


#: Each read and the next, the shorter one padded, so that what one has more differs.
_NEXT = (
    "j AS (SELECT a.read_id, rpad(a.seq, CAST(greatest(length(a.seq), length(c.seq)) AS INTEGER), '-') AS x, "
    "rpad(c.seq, CAST(greatest(length(a.seq), length(c.seq)) AS INTEGER), '-') AS y FROM reads a JOIN reads c ON c.read_id = a.read_id + 1)"
)


@query("hamming_pairs", f"WITH {READS}, {_NEXT} SELECT read_id AS a, read_id + 1 AS b, CAST(hamming(x, y) AS INTEGER) AS d FROM j")
def hamming_pairs(spark: SparkSession, sf: str) -> DataFrame:
    r = reads(spark, sf)
    a, b = r.select(F.col("read_id").alias("a"), F.col("seq").alias("x")), r.select(F.col("read_id").alias("b"), F.col("seq").alias("y"))
    return a.join(b, F.col("b") == F.col("a") + 1).select("a", "b", seq.hamming(_padded("x", "y"), _padded("y", "x")).alias("d"))


@query(
    "diff_positions",
    f"WITH {READS}, {_NEXT}, i AS (SELECT read_id, x, y, unnest(range(1, length(x) + 1)) AS i FROM j) "
    "SELECT read_id, CAST(i AS INTEGER) AS pos FROM i WHERE x[i] <> y[i]",
)
def diff_positions(spark: SparkSession, sf: str) -> DataFrame:
    r = reads(spark, sf)
    a, b = r.select("read_id", F.col("seq").alias("x")), r.select((F.col("read_id") - 1).alias("read_id"), F.col("seq").alias("y"))
    return a.join(b, "read_id").select("read_id", F.explode(seq.diff_positions(_padded("x", "y"), _padded("y", "x"))).alias("pos"))


@query("read_keys", "SELECT event_id, concat(event_id % 7, ':', user_id, ':', event_id) AS key FROM events")
def read_keys(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    name = F.concat_ws(":", F.lit("inst"), F.lit("run"), F.lit("cell"), F.lit("1"), F.col("event_id") % 7, "user_id", F.concat("event_id", F.lit(" 1:N:0")))
    return e.select("event_id", seq.illumina_key(name).alias("key"))


@query("column_names", "SELECT p_partkey, substr('ACGTN', CAST(p_partkey % 5 AS INTEGER) + 1, 1) AS letter, CASE WHEN p_partkey % 5 < 4 THEN substr('ACGT', CAST(p_partkey % 5 AS INTEGER) + 1, 1) ELSE '' END AS base, CASE WHEN p_partkey % 5 < 4 THEN CAST(p_size AS INTEGER) END AS pos FROM part")
def column_names(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").withColumn("letter", F.expr("substr('ACGTN', cast(p_partkey % 5 as int) + 1, 1)"))
    name = F.concat("letter", F.col("p_size").cast("string"))
    return p.select("p_partkey", "letter", seq.column_base(name).alias("base"), seq.column_position(name).alias("pos"))


_CIGAR = "concat(CAST(l_quantity AS INTEGER), '=', l_linenumber, 'X', l_suppkey % 3 + 1, CASE WHEN l_partkey % 2 = 0 THEN 'D' ELSE 'I' END, l_partkey % 9 + 1, 'M')"
_CIGARS = f"cig AS (SELECT l_orderkey, l_linenumber, {_CIGAR} AS cigar FROM lineitem)"


def _cigars(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_CIGAR.replace('INTEGER', 'INT')} AS cigar")


@query("cigar_ops", f"WITH {_CIGARS}, o AS (SELECT unnest(regexp_extract_all(cigar, '(\\d+)([M=XDIS])', 2)) AS op, unnest(regexp_extract_all(cigar, '(\\d+)([M=XDIS])', 1)) AS n FROM cig) SELECT op, count(*) AS n_ops, sum(CAST(n AS BIGINT))::BIGINT AS total FROM o GROUP BY op")
def cigar_ops(spark: SparkSession, sf: str) -> DataFrame:
    ops = _cigars(spark, sf).select(F.explode(seq.cigar_operations(F.col("cigar"))).alias("x")).select("x.*")
    return ops.groupBy("op").agg(F.count(F.lit(1)).alias("n_ops"), F.sum("length").alias("total"))


@query(
    "cigar_consumed",
    f"WITH {_CIGARS}, o AS (SELECT l_orderkey, l_linenumber, unnest(regexp_extract_all(cigar, '(\\d+)([M=XDIS])', 2)) AS op, unnest(regexp_extract_all(cigar, '(\\d+)([M=XDIS])', 1))::BIGINT AS n FROM cig), "
    "k AS (SELECT l_orderkey, sum(CASE WHEN op <> 'I' THEN n ELSE 0 END)::BIGINT AS ref_bases, sum(CASE WHEN op <> 'D' THEN n ELSE 0 END)::BIGINT AS read_bases FROM o GROUP BY 1) SELECT * FROM k",
)
def cigar_consumed(spark: SparkSession, sf: str) -> DataFrame:
    c = _cigars(spark, sf).where(seq.cigar_valid(F.col("cigar")))
    used = lambda ops: F.sum(seq.cigar_consumed(F.col("cigar"), ops))
    return c.groupBy("l_orderkey").agg(used("M=XD").alias("ref_bases"), used("M=XIS").alias("read_bases"))


@query(
    "base_bytes",
    f"WITH {READS} SELECT read_id, list_transform(range(1, length(seq)), lambda i: CAST(CASE seq[i] WHEN 'A' THEN 225 WHEN 'C' THEN 209 WHEN 'G' THEN 177 ELSE 113 END AS INTEGER)) AS low, "
    "list_transform(range(1, length(seq)), lambda i: CAST(CASE WHEN seq[i] = seq[i + 1] THEN 1 ELSE CASE seq[i + 1] WHEN 'A' THEN 16 WHEN 'C' THEN 32 WHEN 'G' THEN 64 ELSE 128 END END AS INTEGER)) AS good FROM reads",
)
def base_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Of each read, the codes of every base with the next one."""
    from chemprobe.operators.reads import compare_base

    n = F.greatest(F.length("seq") - 1, F.lit(0))
    a, b = F.slice(F.split("seq", ""), F.lit(1), n), F.slice(F.split("seq", ""), F.lit(2), n)
    code = lambda good: F.zip_with(a, b, lambda x, y: compare_base(x, y, F.lit(good)))
    return reads(spark, sf).select("read_id", code(False).alias("low"), code(True).alias("good"))


@query("primer_locate", f"WITH {REFS} SELECT ref, CASE WHEN len(string_split(seq, substr(seq, 5, 8))) = 2 THEN CAST(instr(seq, substr(seq, 5, 8)) AS INTEGER) END AS pos5, CASE WHEN len(string_split(seq, substr(seq, 5, 8))) = 2 THEN CAST(instr(seq, substr(seq, 5, 8)) + 7 AS INTEGER) END AS pos3 FROM refs")
def primer_locate(spark: SparkSession, sf: str) -> DataFrame:
    return refs(spark, sf).withColumn("p", seq.locate_primer(F.col("seq"), F.substring("seq", 5, 8))).select("ref", "p.pos5", "p.pos3")


@query(
    "sections_from_primers",
    f"WITH {REFS}, q AS (SELECT *, length(seq) AS n, substr(seq, 5, 12) AS f, substr(seq, length(seq) - 19, 12) AS r FROM refs), "
    "c AS (SELECT *, len(string_split(seq, f)) = 2 AS fo, len(string_split(seq, r)) = 2 AS ro FROM q) "
    "SELECT ref, CASE ref % 3 WHEN 0 THEN 'full' WHEN 1 THEN concat(10, '-', n - 3) ELSE concat(instr(seq, f) + 14, '-', instr(seq, r) - 3) END AS section, "
    "CAST(CASE ref % 3 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE instr(seq, f) + 14 END AS INTEGER) AS end5, "
    "CAST(CASE ref % 3 WHEN 0 THEN n WHEN 1 THEN n - 3 ELSE instr(seq, r) - 3 END AS INTEGER) AS end3 FROM c WHERE ref % 3 < 2 OR (fo AND ro)",
)
def sections_from_primers(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the references whole, a third by coordinates, a third between primers."""
    r = refs(spark, sf)
    two = "ref % 3 = 2"
    specs = r.where("ref % 3 > 0").select(
        "ref", F.expr("if(ref % 3 = 1, 10, null)").alias("end5"), F.expr("if(ref % 3 = 1, -4, null)").alias("end3"), F.expr(f"if({two}, substr(seq, 5, 12), null)").alias("fwd"),
        F.expr(f"if({two}, translate(reverse(substr(seq, length(seq) - 19, 12)), 'ACGT', 'TGCA'), null)").alias("rev"), F.lit(None).cast("string").alias("section"),
    )
    return sec.sections(r, specs).where("valid").select("ref", "section", "end5", "end3")


@query("refs_without_sections", f"WITH {REFS} SELECT ref FROM refs WHERE ref % 3 <> 1")
def refs_without_sections(spark: SparkSession, sf: str) -> DataFrame:
    r = refs(spark, sf).select("ref")
    return sec.without_sections(r, r.where("ref % 3 = 1"))


@query(
    "region_overlap",
    f"WITH {READS}, r AS (SELECT read_id, read_id % 4 AS rname, CAST(read_id % 90 + 1 AS INTEGER) AS pos, length(seq) AS n FROM reads), s AS (SELECT n_nationkey % 4 AS ref, n_name AS section, n_nationkey * 8 + 1 AS end5, n_nationkey * 8 + 20 AS end3 FROM nation) "
    "SELECT read_id, section FROM r JOIN s ON rname = ref AND pos <= end3 AND pos + n - 1 >= end5",
)
def region_overlap(spark: SparkSession, sf: str) -> DataFrame:
    from chemprobe.operators.reads import overlapping

    r = reads(spark, sf).selectExpr("read_id", "read_id % 4 AS rname", "cast(read_id % 90 + 1 as int) AS pos", "concat(length(seq), 'M') AS cigar")
    s = table(spark, sf, "nation").selectExpr("n_nationkey % 4 AS ref", "n_name AS section", "n_nationkey * 8 + 1 AS end5", "n_nationkey * 8 + 20 AS end3")
    return overlapping(r, s).select("read_id", "section")


def _found(pattern: str, start: str, n: int, tolerance: int, mismatches: int) -> str:
    """SQL condition: the pattern lies within its window of r.seq."""
    tests = []
    for d in range(-tolerance, tolerance + 2):
        at = f"({start} + {d})"
        tests.append(f"CASE WHEN {at} >= 1 AND {at} + {n} - 1 <= length(r.seq) THEN hamming(substr(r.seq, {at}, {n}), {pattern}) <= {mismatches} ELSE FALSE END")
    return "(" + " OR ".join(tests) + ")"


def _near(name: str, pattern: str, start: str, n: int, tolerance: int, mismatches: int, source: str = "reads") -> str:
    """SQL tables: `name` (read_id, ref) of all reads and references whose pattern lies within its window."""
    same = f"hamming(w, pat) <= {mismatches}" if mismatches else "w = pat"
    return (
        f"{name}_at AS (SELECT ref, {pattern} AS pat, {start} + d AS p FROM rc b, (SELECT unnest(range({-tolerance}, {tolerance + 2})) AS d) o WHERE {start} + d >= 1), "
        f"{name}_w AS (SELECT read_id, p, substr(seq, p, {n}) AS w FROM {source}, (SELECT DISTINCT p FROM {name}_at) o WHERE p + {n} - 1 <= length(seq)), "
        f"{name} AS (SELECT DISTINCT read_id, ref FROM {name}_w JOIN {name}_at USING (p) WHERE {same})"
    )


def _library(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Reads and the library's patterns, both stored, since a search reads them several times."""
    r = stored(reads(spark, sf), "reads")
    return r, stored(dm.signatures(barcodes(r)), "patterns")


def _search(kind: str, mismatches: int = 0, tolerance: int = 0):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        r, patterns = _library(spark, sf)
        return dm.counts(r, patterns.where(F.col("kind") == kind), mismatches, tolerance).select("ref", "n_reads")

    return run


QUERIES["demux_exact"] = _search("bar")
SQL["demux_exact"] = f"WITH {BARCODES}, {_near('hit', 'b.bar', '21', 12, 0, 0)} SELECT ref, count(*) AS n_reads FROM hit GROUP BY ref"
QUERIES["demux_mismatch"] = _search("bar", 2, 3)
SQL["demux_mismatch"] = f"WITH {BARCODES}, {_near('hit', 'b.bar', '21', 12, 3, 2)} SELECT ref, count(*) AS n_reads FROM hit GROUP BY ref"
QUERIES["demux_reverse"] = _search("rev_bar", 5, 4)
SQL["demux_reverse"] = f"WITH {BARCODES}, {_near('hit', 'b.rbar', '(b.n - 31)', 12, 4, 5)} SELECT ref, count(*) AS n_reads FROM hit GROUP BY ref"


@query("demux_clipped", f"WITH {BARCODES}, late AS (SELECT read_id, concat('AA', seq) AS seq FROM reads), {_near('hit', 'substr(b.bar, 1, 10)', '23', 10, 0, 0, 'late')} SELECT ref, count(*) AS n_reads FROM hit GROUP BY ref")
def demux_clipped(spark: SparkSession, sf: str) -> DataFrame:
    """Barcodes without their last two bases, in reads that begin two bases early."""
    r, patterns = _library(spark, sf)
    patterns = dm.clipped(patterns, 2)
    late = r.withColumn("seq", F.concat(F.lit("AA"), "seq"))
    return dm.counts(late, patterns).select("ref", "n_reads")


QUERIES["demux_secondary"] = _search("sec", 2, dm.SECONDARY_TOLERANCE)
SQL["demux_secondary"] = f"WITH {BARCODES}, {_near('hit', 'b.sec', '41', 8, 2, 2)} SELECT ref, count(*) AS n_reads FROM hit GROUP BY ref"

#: Barcodes are sought everywhere, second signatures where a barcode is.
_HITS = (
    BARCODES
    + f", {_near('nb', 'b.bar', '21', 12, 2, 2)}, {_near('nr', 'b.rbar', '(b.n - 31)', 12, 2, 2)}, "
    "pairs AS (SELECT read_id, ref, bool_or(f) AS bar, bool_or(NOT f) AS rbar FROM (SELECT *, TRUE AS f FROM nb UNION ALL SELECT *, FALSE FROM nr) q GROUP BY 1, 2), "
    f"h AS (SELECT r.read_id, b.ref, p.bar, p.rbar, {_found('b.sec', '41', 8, 2, 2)} AS sec, {_found('b.rsec', '(b.n - 47)', 8, 2, 2)} AS rsec FROM pairs p JOIN reads r USING (read_id) JOIN rc b USING (ref)), "
    "got AS (SELECT read_id, ref FROM h WHERE sec OR rsec), one AS (SELECT read_id FROM got GROUP BY 1 HAVING count(*) = 1)"
)


@query("demux_assigned", f"WITH {_HITS} SELECT read_id, ref FROM got")
def demux_assigned(spark: SparkSession, sf: str) -> DataFrame:
    r, patterns = _library(spark, sf)
    return dm.assigned_pairs(r, patterns, 2, 2)


@query("demux_multihit_removed", f"WITH {_HITS} SELECT read_id, ref, 'R1' AS found_by FROM got WHERE read_id IN (SELECT read_id FROM one)")
def demux_multihit_removed(spark: SparkSession, sf: str) -> DataFrame:
    r, patterns = _library(spark, sf)
    return dm.assigned_once(r, patterns, 2, 2).withColumn("found_by", F.lit("R1"))


@query(
    "demux_report",
    f"WITH {_HITS}, fin AS (SELECT ref, count(*) AS k FROM got WHERE read_id IN (SELECT read_id FROM one) GROUP BY 1) "
    "SELECT l.ref, count(CASE WHEN h.bar THEN 1 END) AS init_barcode, count(CASE WHEN h.rbar THEN 1 END) AS init_rev_barcode, count(CASE WHEN h.sec THEN 1 END) AS sec_hits, count(CASE WHEN h.rsec THEN 1 END) AS rev_sec_hits, "
    "count(h.read_id) AS unfiltered, count(CASE WHEN h.sec OR h.rsec THEN 1 END) AS pre_union, coalesce(max(k), 0) AS final_count, "
    "count(CASE WHEN NOT (h.sec OR h.rsec) THEN 1 END) AS reads_lost_to_filter FROM rc l LEFT JOIN h ON h.ref = l.ref LEFT JOIN fin ON fin.ref = l.ref GROUP BY l.ref",
)
def demux_report(spark: SparkSession, sf: str) -> DataFrame:
    r, patterns = _library(spark, sf)
    return dm.report_one(r, patterns, 2, 2).select("ref", "init_barcode", "init_rev_barcode", "sec_hits", "rev_sec_hits", "unfiltered", "pre_union", "final_count", "reads_lost_to_filter")


@query("set_ops", "SELECT 'union' AS op, count(*) AS n FROM (SELECT o_custkey FROM orders UNION SELECT c_custkey FROM customer) a UNION ALL SELECT 'difference', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) a UNION ALL SELECT 'intersection', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) a")
def set_ops(spark: SparkSession, sf: str) -> DataFrame:
    a, b = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    count = lambda df, op: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")
    return count(a.union(b).distinct(), "union").unionByName(count(a.distinct().join(b, "k", "left_anti"), "difference")).unionByName(count(a.intersect(b), "intersection"))


@query("unrepeated", "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1 HAVING count(*) = 1")
def unrepeated(spark: SparkSession, sf: str) -> DataFrame:
    """Work that is listed twice is dropped altogether."""
    o = table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("o_orderkey")).where("n = 1").select("o_custkey", "o_orderkey")


@query("missing_outputs", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def missing_outputs(spark: SparkSession, sf: str) -> DataFrame:
    from chemprobe.sources.sam import expected_missing

    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return expected_missing(table(spark, sf, "customer").select("c_custkey"), done, ["c_custkey"])
