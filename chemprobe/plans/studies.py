"""Queries over the study table, metadata, statistics and nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.functions import stats
from chemprobe.operators import aggregate as agg
from chemprobe.operators import study as st
from chemprobe.plans.views import PROFILES, profiles, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _study(spark: SparkSession, sf: str, **options) -> st.Study:
    return st.Study(profiles(spark, sf), **options)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


_RATE = "round(sub_rate, 6) AS sub_rate"


@query("study_filter", f"WITH {PROFILES} SELECT sample, reference, pos, base, paired, {_RATE} FROM prof JOIN tops USING (sample, reference) WHERE sample IN ('s0', 's2') AND min_cov >= 500 AND reference <> 'r0'")
def study_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = _study(spark, sf, min_cov=500).mutation_fraction(sample=["s0", "s2"], reference=["r1", "r2", "r3"])
    return _rounded(rows.drop("section", "cluster"), "sub_rate")


@query("study_complete", f"WITH {PROFILES} SELECT sample, reference, pos, cov FROM prof WHERE reference IN (SELECT reference FROM prof GROUP BY 1 HAVING count(DISTINCT sample) = 3)")
def study_complete(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf, complete=True).base_coverage().select("sample", "reference", "pos", "cov")


@query("study_base_index", f"WITH {PROFILES} SELECT sample, reference, pos, {_RATE} FROM prof WHERE pos IN (2, 3, 5)")
def study_base_index(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_study(spark, sf).mutation_fraction(base_index=[2, 3, 5]).select("sample", "reference", "pos", "sub_rate"), "sub_rate")


@query("study_base_motif", f"WITH {PROFILES} SELECT sample, reference, pos, base FROM prof WHERE pos BETWEEN 2 AND 4")
def study_base_motif(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of a motif that occurs once."""
    return _study(spark, sf).mutation_fraction(base_index="GTA").select("sample", "reference", "pos", "base")


@query("study_base_type", f"WITH {PROFILES} SELECT sample, reference, pos, base, cov FROM prof WHERE base IN ('A', 'C') AND pos > 1")
def study_base_type(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf).base_coverage(base_type=["A", "C"], base_index=[2, 3, 4, 5, 6, 7]).select("sample", "reference", "pos", "base", "cov")


@query("study_pairing", f"WITH {PROFILES} SELECT sample, reference, pos, cov FROM prof WHERE NOT paired")
def study_pairing(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf).base_coverage(base_pairing=False).select("sample", "reference", "pos", "cov")


@query("study_unique_id", f"WITH {PROFILES} SELECT DISTINCT sample, reference, concat(sample, '_', reference) AS unique_id FROM prof")
def study_unique_id(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf).get_df().select("sample", "reference", "unique_id")


@query("study_distinct", f"WITH {PROFILES} SELECT DISTINCT reference FROM prof WHERE sample = 's2'")
def study_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf).distinct("reference", sample="s2")


@query("study_delta", f"WITH {PROFILES} SELECT a.pos, a.base, round(a.sub_rate - b.sub_rate, 6) AS delta FROM prof a JOIN prof b ON a.pos = b.pos AND a.sample = 's0' AND b.sample = 's1' AND a.reference = 'r1' AND b.reference = 'r2'")
def study_delta(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_study(spark, sf).fraction_delta({"sample": "s0", "reference": "r1"}, {"sample": "s1", "reference": "r2"}), "delta")


@query(
    "study_compare_pairs",
    f"WITH {PROFILES}, p AS (SELECT concat(sample, '_', reference) AS id, pos, sub_rate FROM prof) "
    "SELECT a.id AS id1, b.id AS id2, count(*) AS n, round(regr_slope(b.sub_rate, a.sub_rate), 6) AS slope, round(regr_intercept(b.sub_rate, a.sub_rate), 6) AS intercept, round(regr_r2(b.sub_rate, a.sub_rate), 6) AS r2 FROM p a JOIN p b ON a.pos = b.pos AND a.id < b.id AND a.sub_rate IS NOT NULL AND b.sub_rate IS NOT NULL GROUP BY 1, 2",
)
def study_compare_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_study(spark, sf).compare_profiles().drop("rmse"), "slope", "intercept", "r2")


@query("study_identity", f"WITH {PROFILES} SELECT sample, reference, pos, " + ", ".join(f"round(sub_{b} / CAST(info AS DOUBLE), 6) AS rate_{b}" for b in "ACGT") + " FROM prof WHERE info > 0")
def study_identity(spark: SparkSession, sf: str) -> DataFrame:
    rows = _study(spark, sf).mutation_fraction_identity().where("info > 0")
    return _rounded(rows.select("sample", "reference", "pos", *[f"rate_{b}" for b in "ACGT"]), *[f"rate_{b}" for b in "ACGT"])


@query("study_coverage", f"WITH {PROFILES} SELECT sample, reference, pos, base, cov FROM prof")
def study_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf).base_coverage().select("sample", "reference", "pos", "base", "cov")


_HIST = "per AS (SELECT sample, reference, read, sum(CASE WHEN b <> 0 AND (b | 240) = 240 THEN 1 ELSE 0 END)::BIGINT AS n FROM v GROUP BY 1, 2, 3)"


def _with_hist(spark: SparkSession, sf: str) -> DataFrame:
    from chemprobe.operators.profile import sub_hist
    from chemprobe.plans.views import vec

    v = vec(spark, sf).withColumns({"sample": F.expr("concat('s', read % 3)"), "reference": F.expr("concat('r', read % 4)")}).where("NOT (read % 3 = 2 AND read % 4 = 3)")
    bins = F.array_sort(F.collect_list(F.struct("n_muts", "n_reads")))
    hist = sub_hist(v, ["sample", "reference"]).groupBy("sample", "reference").agg(bins.alias("h"))
    return profiles(spark, sf).join(hist.select("sample", "reference", F.col("h.n_reads").alias("sub_hist")), ["sample", "reference"])


@query("study_hist_by_sample", f"WITH {PROFILES}, {_HIST} SELECT sample, CAST(n AS INTEGER) AS n_muts, count(*) AS n_reads FROM per GROUP BY 1, 2")
def study_hist_by_sample(spark: SparkSession, sf: str) -> DataFrame:
    return st.Study(_with_hist(spark, sf)).hist_by_sample().where("n_reads > 0")


@query("study_hist", f"WITH {PROFILES}, {_HIST} SELECT sample, reference, CAST(n AS INTEGER) AS n_muts, count(*) AS n_reads FROM per GROUP BY 1, 2, 3")
def study_hist(spark: SparkSession, sf: str) -> DataFrame:
    return st.Study(_with_hist(spark, sf)).hist().where("n_reads > 0").select("sample", "reference", "n_muts", "n_reads")


@query("study_reads_distribution", f"WITH {PROFILES} SELECT num_aligned, count(*) AS n_references FROM aligned GROUP BY 1")
def study_reads_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf).reads_distribution()


@query("study_delta_g", f"WITH {PROFILES} SELECT sample, reference, pos, paired, -(CAST(substr(reference, 2) AS DOUBLE) + 0.5) AS \"deltaG\", {_RATE} FROM prof")
def study_delta_g(spark: SparkSession, sf: str) -> DataFrame:
    rows = _study(spark, sf).delta_g_vs_sub_rate().select("sample", "reference", "pos", "paired", F.col("deltaG").cast("double").alias("deltaG"), "sub_rate")
    return _rounded(rows, "sub_rate")


@query("study_variable_pivot", f"WITH {PROFILES} SELECT sample, " + ", ".join(f'round(max(CASE WHEN pos = {p} THEN sub_rate END), 6) AS "{p}"' for p in range(1, 8)) + " FROM prof WHERE reference = 'r1' GROUP BY sample")
def study_variable_pivot(spark: SparkSession, sf: str) -> DataFrame:
    rows = _study(spark, sf).variable_across_samples("sample", reference="r1")
    return rows.select("sample", *[F.round(f"`{p}`", 6).alias(str(p)) for p in range(1, 8)])


@query("study_sections", f"WITH {PROFILES}, lib AS (SELECT * FROM (VALUES ('r1', 'head', 1, 3), ('r2', 'tail', 5, 7)) t(reference, section, s, e)) SELECT sample, section, reference, sum(cov)::BIGINT AS cov FROM prof JOIN lib USING (reference) WHERE pos BETWEEN s AND e GROUP BY 1, 2, 3")
def study_sections(spark: SparkSession, sf: str) -> DataFrame:
    lib = spark.createDataFrame([("r1", "head", 1, 3), ("r2", "tail", 5, 7)], "reference string, section string, section_start int, section_end int")
    rows = _study(spark, sf).add_sections(lib).where("section <> 'full'")
    return rows.select("sample", "section", "reference", F.aggregate("cov", F.lit(0).cast("long"), lambda a, x: a + x).alias("cov"))


@query(
    "gini",
    "WITH r AS (SELECT c_nationkey, abs(c_acctbal) AS x, row_number() OVER (PARTITION BY c_nationkey ORDER BY abs(c_acctbal)) AS i, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer) SELECT c_nationkey, round(sum((2 * i - n - 1) * x) / (max(n) * sum(x)), 6) AS gini FROM r GROUP BY 1",
)
def gini(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_nationkey", F.abs("c_acctbal").alias("x"))
    return _rounded(stats.gini(c, ["c_nationkey"], "x"), "gini")


@query(
    "roc_auc",
    "WITH c AS (SELECT c_nationkey, c_acctbal AS x, c_mktsegment = 'BUILDING' AS y FROM customer), p AS (SELECT a.c_nationkey AS k, sum(CASE WHEN a.x > b.x THEN 1.0 WHEN a.x = b.x THEN 0.5 ELSE 0 END) AS s, count(*) AS n FROM c a JOIN c b ON a.c_nationkey = b.c_nationkey AND a.y AND NOT b.y GROUP BY 1) "
    "SELECT d.c_nationkey, round(CAST(s AS DOUBLE) / n, 6) AS auc FROM (SELECT DISTINCT c_nationkey FROM c) d LEFT JOIN p ON k = d.c_nationkey",
)
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_nationkey", F.col("c_acctbal").alias("x"), (F.col("c_mktsegment") == "BUILDING").alias("y"))
    return _rounded(stats.auc(c, ["c_nationkey"], "x", "y"), "auc")


@query(
    "wilson_ci",
    "WITH c AS (SELECT c_nationkey, count(*) AS n, count(CASE WHEN c_acctbal > 5000 THEN 1 END) / CAST(count(*) AS DOUBLE) AS p FROM customer GROUP BY 1), z AS (SELECT *, 1.959963984540054 AS z FROM c) "
    "SELECT c_nationkey, round((p + z * z / 2 / n - z * sqrt(p * (1 - p) / n + z * z / 4 / n / n)) / (1 + z * z / n), 6) AS low, round((p + z * z / 2 / n + z * sqrt(p * (1 - p) / n + z * z / 4 / n / n)) / (1 + z * z / n), 6) AS high FROM z",
)
def wilson_ci(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("c_acctbal") > 5000, 1)).alias("k"))
    lo, hi = stats.wilson(F.col("k"), F.col("n"))
    return c.select("c_nationkey", F.round(lo, 6).alias("low"), F.round(hi, 6).alias("high"))


@query("regression", "SELECT l_returnflag, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY 1")
def regression(spark: SparkSession, sf: str) -> DataFrame:
    f = stats.linear_fit(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return f.select("l_returnflag", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"))


_LIB = "lib AS (SELECT concat('ref', n_nationkey) AS reference, n_nationkey % 5 * 10 + 1 AS section_start, n_nationkey % 5 * 10 + 20 AS section_end, CASE WHEN n_nationkey % 3 = 0 THEN n_name END AS section, r_name AS family FROM nation JOIN region ON n_regionkey = r_regionkey)"


def _library(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    return n.selectExpr("concat('ref', n_nationkey) AS reference", "n_nationkey % 5 * 10 + 1 AS section_start", "n_nationkey % 5 * 10 + 20 AS section_end", "if(n_nationkey % 3 = 0, n_name, null) AS section", "r_name AS family")


@query(
    "library_join",
    f"WITH {_LIB} SELECT c_custkey, concat('ref', c_nationkey % 30) AS reference, family, coalesce(l.section, concat(c_nationkey % 5 * 10 + 1, '-', c_nationkey % 5 * 10 + 20)) AS section FROM customer LEFT JOIN lib l ON l.reference = concat('ref', c_nationkey % 30)",
)
def library_join(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "customer").selectExpr("c_custkey", "concat('ref', c_nationkey % 30) AS reference", "c_nationkey % 5 * 10 + 1 AS section_start", "c_nationkey % 5 * 10 + 20 AS section_end")
    lib = _library(spark, sf)
    return agg.with_library(agg.with_section_names(p, lib), lib).select("c_custkey", "reference", "family", "section")


@query("samples_join", "SELECT o_orderkey, c_name AS sample, c_mktsegment AS buffer FROM orders JOIN customer ON o_custkey = c_custkey")
def samples_join(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").selectExpr("c_custkey", "c_name AS sample", "c_mktsegment AS buffer")
    o = table(spark, sf, "orders").join(c.select("c_custkey", "sample"), F.expr("o_custkey = c_custkey")).select("o_orderkey", "sample")
    return agg.with_sample(o, c.drop("c_custkey"))


@query(
    "library_checks",
    "SELECT concat('p', p_partkey) AS reference, 'outside the reference' AS problem FROM part WHERE p_size > 40 AND p_partkey % 20 <> 0 UNION SELECT concat('p', p_partkey), 'not in the references' FROM part WHERE p_partkey % 20 = 0",
)
def library_checks(spark: SparkSession, sf: str) -> DataFrame:
    """All parts against references that lack every twentieth."""
    part = table(spark, sf, "part")
    lib = part.selectExpr("concat('p', p_partkey) AS reference", "cast(null as string) AS section", "1 AS section_start", "cast(p_size as int) AS section_end", "p_brand AS family")
    refs = part.where("p_partkey % 20 <> 0").selectExpr("concat('p', p_partkey) AS ref", "repeat('A', 40) AS seq")
    return agg.library_problems(lib, refs)


@query("dedupe_sections", "SELECT DISTINCT n_regionkey AS reference, CAST(n_nationkey % 3 AS INTEGER) + 1 AS section_start, CAST(n_nationkey % 3 AS INTEGER) + 5 AS section_end FROM nation")
def dedupe_sections(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").selectExpr("n_regionkey AS reference", "cast(n_nationkey % 3 as int) + 1 AS section_start", "cast(n_nationkey % 3 as int) + 5 AS section_end")
    return n.dropDuplicates(["reference", "section_start", "section_end"])


@query("json_flatten", "SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS value FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return e.select("event_id", F.explode("m").alias("name", "value")).where("value IS NOT NULL")


@query("document_round_trip", f"WITH {PROFILES} SELECT sample, reference, 'full' AS section, CAST(num_aligned AS VARCHAR) AS num_aligned, CAST(min_cov AS VARCHAR) AS min_cov FROM tops JOIN aligned USING (sample, reference)")
def document_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles to sample documents and back."""
    p = profiles(spark, sf).select("sample", "reference", "section", "cluster", "num_aligned", "min_cov", "cov", "sub_rate")
    docs = agg.sample_documents(p.withColumn("user", F.lit("u")), ["user"], ["num_aligned"], [])
    flat = agg.flatten_documents(docs.select(F.expr("concat('{\"sample\":\"', sample, '\",', substring(document, 2))").alias("document")))
    return flat.select("sample", "reference", "section", F.col("reference_attributes")["num_aligned"].alias("num_aligned"), F.col("values")["min_cov"].alias("min_cov"))
