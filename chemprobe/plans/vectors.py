"""Queries over mutation vectors: bit queries, profiles, filters, clustering inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.functions.bits import mut_match, mut_overlap, rendered
from chemprobe.operators import preprocess as pre
from chemprobe.operators import profile as prof
from chemprobe.operators.reads import best_alignments, covered, mate_consensus
from chemprobe.plans import views
from chemprobe.plans.views import PROFILE_COUNTS, table, vec, vec_sql

#: Bytes that the bit queries ask for.
ASKED = [0, 1, 2, 5, 8, 14, 16, 64, 112, 240, 241, 255]

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _bits(match, condition: str) -> tuple:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        one = vec(spark, sf).agg(*[F.sum(match(F.col("b"), q).cast("long")).alias(f"q{q}") for q in ASKED])
        return one.select(F.explode(F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"q{q}").alias("n_match")) for q in ASKED])).alias("x")).select("x.*")

    asked = ", ".join(f"({q})" for q in ASKED)
    sql = f"WITH {vec_sql()} SELECT q, sum(CASE WHEN {condition} THEN 1 ELSE 0 END)::BIGINT AS n_match FROM vec, (VALUES {asked}) a(q) GROUP BY q"
    return run, sql


for _name, _match, _sql in (
    ("bit_exact", lambda b, q: mut_match(b, q), "b <> 0 AND b = q"),
    ("bit_subset", lambda b, q: mut_match(b, q, subsets=True), "b <> 0 AND (b | q) = q"),
    ("bit_superset", lambda b, q: mut_match(b, q, supersets=True), "b <> 0 AND (b & q) = q"),
    ("bit_either", lambda b, q: mut_match(b, q, subsets=True, supersets=True), "b <> 0 AND ((b | q) = q OR (b & q) = q)"),
    ("bit_overlap", lambda b, q: mut_overlap(b, q), "(b & q) <> 0"),
):
    QUERIES[_name], SQL[_name] = _bits(_match, _sql)

_RATE = "round(CASE WHEN match + sub_N > 0 THEN sub_N / CAST(match + sub_N AS DOUBLE) END, 9) AS sub_rate"


@query("profile_by_pos", f"WITH {vec_sql()}, c AS (SELECT pos, {PROFILE_COUNTS} FROM vec GROUP BY pos) SELECT *, match + sub_N AS info, {_RATE} FROM c")
def profile_by_pos(spark: SparkSession, sf: str) -> DataFrame:
    return prof.profile_by_pos(vec(spark, sf)).withColumn("sub_rate", F.round("sub_rate", 9))


_SECTIONS = "sec AS (SELECT n_name AS section, n_nationkey % 3 AS ref, n_nationkey % 4 + 1 AS end5, least(n_nationkey % 4 + 1 + n_nationkey % 3, 7) AS end3 FROM nation)"


@query(
    "profile_sections",
    f"WITH {vec_sql()}, {_SECTIONS}, c AS (SELECT section, pos, {PROFILE_COUNTS} FROM vec JOIN sec ON read % 3 = ref AND pos BETWEEN end5 AND end3 GROUP BY 1, 2) SELECT section, pos, cov, sub_N, match + sub_N AS info FROM c",
)
def profile_sections(spark: SparkSession, sf: str) -> DataFrame:
    sec = table(spark, sf, "nation").selectExpr("n_name AS section", "n_nationkey % 3 AS ref", "n_nationkey % 4 + 1 AS end5", "least(n_nationkey % 4 + 1 + n_nationkey % 3, 7) AS end3")
    rows = vec(spark, sf).join(F.broadcast(sec), F.expr("read % 3 = ref AND pos BETWEEN end5 AND end3"))  # 25 nations
    return prof.profile_by_pos(rows, ["section"]).select("section", "pos", "cov", "sub_N", "info")


@query("count_by_pos", f"WITH {vec_sql()} SELECT pos, sum(CASE WHEN b <> 0 AND (b | 14) = 14 THEN 1 ELSE 0 END)::BIGINT AS n FROM vec GROUP BY pos")
def count_by_pos(spark: SparkSession, sf: str) -> DataFrame:
    return prof.count_by_pos(vec(spark, sf), 14, subsets=True)


_PER_READ = "per AS (SELECT read, sum(CASE WHEN b <> 0 AND (b | 240) = 240 THEN 1 ELSE 0 END)::BIGINT AS n FROM vec GROUP BY read)"


@query("muts_per_read", f"WITH {vec_sql()}, {_PER_READ} SELECT * FROM per")
def muts_per_read(spark: SparkSession, sf: str) -> DataFrame:
    return prof.count_by_read(vec(spark, sf))


@query(
    "sub_hist",
    f"WITH {vec_sql()}, {_PER_READ}, bins AS (SELECT unnest(range(0, (SELECT max(n) FROM per) + 1)) AS n_muts) SELECT n_muts, count(read) AS n_reads FROM bins LEFT JOIN per ON n = n_muts GROUP BY 1",
)
def sub_hist(spark: SparkSession, sf: str) -> DataFrame:
    return prof.sub_hist(vec(spark, sf))


@query("min_cov", f"WITH {vec_sql()} SELECT min(c) AS min_cov FROM (SELECT pos, count(CASE WHEN b <> 0 THEN 1 END) AS c FROM vec GROUP BY pos) q")
def min_cov(spark: SparkSession, sf: str) -> DataFrame:
    return prof.min_cov(prof.profile_by_pos(vec(spark, sf)))


@query("num_aligned", f"WITH {vec_sql()} SELECT count(DISTINCT read) AS num_aligned FROM vec")
def num_aligned(spark: SparkSession, sf: str) -> DataFrame:
    return prof.num_aligned(vec(spark, sf))


_MEMBERS = (
    "mem0 AS (SELECT vec_id AS read, exp(CAST(embedding[1] AS DOUBLE)) AS a, exp(CAST(embedding[2] AS DOUBLE)) AS c FROM embeddings), "
    "mem AS (SELECT read, 1 AS cluster, a / (a + c) AS p FROM mem0 UNION ALL SELECT read, 2, c / (a + c) FROM mem0)"
)


@query(
    "cluster_rates",
    f"WITH {vec_sql()}, {_MEMBERS}, mine AS (SELECT * FROM mem WHERE read IN (SELECT read FROM vec)), w AS (SELECT cluster, sum(p) AS w FROM mine GROUP BY 1) "
    "SELECT m.cluster, pos, round(sum(CASE WHEN b <> 0 AND (b | 240) = 240 THEN p ELSE 0 END) / max(w.w), 6) AS rate FROM vec JOIN mine m USING (read) JOIN w ON w.cluster = m.cluster GROUP BY 1, 2",
)
def cluster_rates(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("read"), F.exp(F.col("embedding")[0].cast("double")).alias("a"), F.exp(F.col("embedding")[1].cast("double")).alias("c"))
    rows = F.array(F.struct(F.lit(1).alias("cluster"), (F.col("a") / (F.col("a") + F.col("c"))).alias("p")), F.struct(F.lit(2).alias("cluster"), (F.col("c") / (F.col("a") + F.col("c"))).alias("p")))
    mem = e.select("read", F.explode(rows).alias("x")).select("read", "x.*")
    return prof.cluster_rates(vec(spark, sf), mem).withColumn("rate", F.round("rate", 6))


@query(
    "unique_patterns",
    f"WITH {vec_sql()}, p AS (SELECT read, string_agg(CASE WHEN b <> 0 AND (b | 240) = 240 THEN '1' ELSE '0' END, '' ORDER BY pos) AS pattern FROM vec GROUP BY read) SELECT pattern, count(*) AS n, min(read) AS first_read FROM p GROUP BY 1",
)
def unique_patterns(spark: SparkSession, sf: str) -> DataFrame:
    return pre.unique_patterns(vec(spark, sf))


@query("filter_bases", f"WITH {vec_sql()} SELECT DISTINCT pos, base FROM vec WHERE base IN ('A', 'C')")
def filter_bases(spark: SparkSession, sf: str) -> DataFrame:
    return pre.keep_bases(vec(spark, sf)).select("pos", "base").distinct()


_OUT = (
    "ac AS (SELECT * FROM vec WHERE base IN ('A', 'C')), odd AS (SELECT read, sum(CASE WHEN b <> 0 AND (b | 254) = 254 THEN 1 ELSE 0 END)::BIGINT AS n FROM ac GROUP BY 1), "
    "outl AS (SELECT * FROM odd WHERE n > (SELECT avg(n) + 3 * stddev_samp(n) FROM odd)), calm AS (SELECT * FROM ac WHERE read NOT IN (SELECT read FROM outl))"
)
_WEAK = (
    "sig AS (SELECT pos, sum(CASE WHEN b IN (1, 5) THEN 1 ELSE 0 END) AS m, sum(CASE WHEN b <> 0 AND (b | 240) = 240 THEN 1 ELSE 0 END) AS x FROM calm GROUP BY 1), "
    "weak AS (SELECT pos FROM sig WHERE m + x > 0 AND x / CAST(m + x AS DOUBLE) < {t}), strong AS (SELECT * FROM calm WHERE pos NOT IN (SELECT pos FROM weak))"
)
_CLOSE = (
    "gaps AS (SELECT read, pos - lag(pos) OVER (PARTITION BY read ORDER BY pos) AS g FROM strong WHERE b <> 0 AND (b | 240) = 240), "
    "crowd AS (SELECT DISTINCT read FROM gaps WHERE g < 4), used AS (SELECT * FROM strong WHERE read NOT IN (SELECT read FROM crowd))"
)


@query("filter_3sigma", f"WITH {vec_sql()}, {_OUT} SELECT * FROM outl")
def filter_3sigma(spark: SparkSession, sf: str) -> DataFrame:
    return pre.outlying_reads(pre.keep_bases(vec(spark, sf)))


@query("filter_low_signal", f"WITH {vec_sql()}, {_OUT}, {_WEAK.format(t=0.9)} SELECT pos FROM weak")
def filter_low_signal(spark: SparkSession, sf: str) -> DataFrame:
    bases = pre.keep_bases(vec(spark, sf))
    return pre.weak_positions(bases.join(pre.outlying_reads(bases), "read", "left_anti"), 0.9)


@query("filter_close_muts", f"WITH {vec_sql()}, strong AS (SELECT * FROM vec), {_CLOSE} SELECT * FROM crowd")
def filter_close_muts(spark: SparkSession, sf: str) -> DataFrame:
    return pre.crowded_reads(vec(spark, sf))


@query(
    "preprocess_report",
    f"WITH {vec_sql()}, {_OUT}, {_WEAK.format(t=0.005)}, {_CLOSE} "
    + " UNION ALL ".join(
        f"SELECT '{step}' AS step, count(DISTINCT {col}) AS n FROM {src}"
        for step, src, col in (
            ("reads", "vec", "read"), ("positions", "vec", "pos"), ("positions_ac", "ac", "pos"), ("reads_outlying", "outl", "read"),
            ("positions_weak", "weak", "pos"), ("reads_crowded", "crowd", "read"), ("reads_used", "used", "read"), ("positions_used", "used", "pos"),
        )
    ),
)
def preprocess_report(spark: SparkSession, sf: str) -> DataFrame:
    return pre.report(vec(spark, sf))


@query("preprocessed_vectors", f"WITH {vec_sql()}, {_OUT}, {_WEAK.format(t=0.005)}, {_CLOSE} SELECT read, pos, base, b FROM used")
def preprocessed_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return pre.preprocess(vec(spark, sf)).select("read", "pos", "base", "b")


_MATES = vec_sql("l_suppkey % 2 AS mate", "two")


@query(
    "mate_consensus",
    f"WITH {_MATES}, j AS (SELECT coalesce(a.read, c.read) AS read, coalesce(a.pos, c.pos) AS pos, coalesce(a.b, 0) AS x, coalesce(c.b, 0) AS y FROM (SELECT * FROM two WHERE mate = 0) a FULL JOIN (SELECT * FROM two WHERE mate = 1) c ON a.read = c.read AND a.pos = c.pos) "
    "SELECT read, pos, CASE WHEN (x & y) <> 0 THEN x & y ELSE x | y END AS b FROM j",
)
def consensus_of_mates(spark: SparkSession, sf: str) -> DataFrame:
    two = vec(spark, sf, "l_suppkey % 2 AS mate")
    return mate_consensus(two.where("mate = 0").select("read", "pos", "b"), two.where("mate = 1").select("read", "pos", "b"))


@query("covered_reads", f"WITH {vec_sql()} SELECT read, max(b) AS most FROM vec GROUP BY 1 HAVING max(b) > 0")
def covered_reads(spark: SparkSession, sf: str) -> DataFrame:
    return covered(vec(spark, sf)).groupBy("read").agg(F.max("b").alias("most"))


@query(
    "best_alignment",
    "WITH e AS (SELECT event_id, user_id, event_id % 50 AS pair, CAST(floor(value) AS INTEGER) AS a, CAST(json_extract_string(props, '$.k') AS INTEGER) AS x FROM events), "
    "ok AS (SELECT user_id, pair FROM e GROUP BY 1, 2 HAVING bool_and(x IS NULL OR x < coalesce(a, -2147483648))) SELECT event_id FROM e JOIN ok USING (user_id, pair)",
)
def best_alignment(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").selectExpr("event_id", "user_id", "event_id % 50 AS pair", "cast(floor(value) as int) AS as_score", "cast(get_json_object(props, '$.k') as int) AS xs_score")
    return best_alignments(e, ["user_id", "pair"]).select("event_id")


def _glyphs_sql() -> str:
    from chemprobe.functions.codes import glyph

    return "CASE b " + " ".join(f"WHEN {c} THEN '{glyph(c)}'" for c in range(256) if glyph(c) != "?") + " ELSE '?' END"


@query("vector_text", f"WITH {vec_sql()} SELECT read, string_agg({_glyphs_sql()}, '' ORDER BY pos) AS line FROM vec GROUP BY read")
def vector_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = vec(spark, sf).groupBy("read").agg(F.array_sort(F.collect_list(F.struct("pos", "b"))).alias("r"))
    return rows.select("read", rendered(F.transform("r", lambda x: x["b"])).alias("line"))


@query("profile_from_arrays", f"WITH {vec_sql()}, f AS (SELECT read FROM vec GROUP BY 1 HAVING count(*) = 7), c AS (SELECT pos, {PROFILE_COUNTS} FROM vec WHERE read IN (SELECT read FROM f) GROUP BY pos) SELECT pos, cov, sub_N, match + sub_N AS info, del, ins FROM c")
def profile_from_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of compact vectors; only reads that span the section have one here."""
    rows = vec(spark, sf).groupBy("read").agg(F.array_sort(F.collect_list(F.struct("pos", "b"))).alias("r")).where("size(r) = 7")
    arrays = rows.select("read", F.transform("r", lambda x: x["b"].cast("smallint")).alias("vec"), F.lit(1).alias("end5"))
    return prof.array_profile(arrays, []).select("pos", "cov", "sub_N", "info", "del", "ins")


@query(
    "profile_round_trip",
    f"WITH {views.PROFILES} SELECT sample, reference, pos, cov, sub_N, info FROM prof",
)
def profile_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Long profiles packed to arrays and unpacked again."""
    return prof.unpacked(views.profiles(spark, sf), ["sample", "reference"], ["cov", "sub_N", "info"])
