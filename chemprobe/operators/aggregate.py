"""Profiles with their metadata, and the nested sample document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Attributes that a sample has to have, by kind of experiment.
REQUIRED = ["sample", "user", "date", "exp_env", "temperature_k", "inc_time_tot_secs"]
REQUIRED_BY_ENV = {"in_vitro": ["buffer"], "in_vivo": ["cell_line"]}
LIBRARY_PLACES = ["section", "section_start", "section_end", "barcode_start", "barcode_length", "secondary_signature_start", "secondary_signature_length"]


def with_library(profiles: DataFrame, library: DataFrame) -> DataFrame:
    """Adds a reference's attributes: one row per reference, its smallest; places of sections are left out."""
    extra = [c for c in library.columns if c not in ("reference", *LIBRARY_PLACES)]
    if not extra:
        return profiles
    one = library.groupBy("reference").agg(*[F.min(c).alias(c) for c in extra])
    return profiles.join(one, "reference", "left")


def with_section_names(profiles: DataFrame, library: DataFrame) -> DataFrame:
    """Names sections as the library does, else by `start-end`."""
    named = library.where("section IS NOT NULL").select("reference", "section_start", "section_end", F.col("section").alias("_name")).distinct()
    out = profiles.join(named, ["reference", "section_start", "section_end"], "left")
    return out.withColumn("section", F.coalesce("_name", F.concat_ws("-", "section_start", "section_end"))).drop("_name")


def with_sample(profiles: DataFrame, samples: DataFrame) -> DataFrame:
    """Adds a sample's attributes; samples that are not listed exactly once are an error."""
    problems = profiles.select("sample").distinct().join(samples.groupBy("sample").agg(F.count(F.lit(1)).alias("n")), "sample", "left").where("coalesce(n, 0) <> 1")
    bad = [r["sample"] for r in problems.limit(5).collect()]
    if bad:
        raise ValueError(f"samples are not listed exactly once: {bad}")
    return profiles.join(samples, "sample")


def sample_problems(samples: DataFrame) -> DataFrame:
    """(sample, problem) for unknown environments, missing attributes and repeated samples."""
    env = F.col("exp_env")
    rows = samples.where(~F.coalesce(env.isin(*REQUIRED_BY_ENV), F.lit(False))).select("sample", F.lit("exp_env").alias("problem"))
    for c in REQUIRED:
        part = samples.where(F.col(c).isNull()) if c in samples.columns else samples
        rows = rows.unionByName(part.select("sample", F.lit(f"no {c}").alias("problem")))
    for kind, names in REQUIRED_BY_ENV.items():
        for c in names:
            missing = samples.where(env == kind)
            missing = missing.where(F.col(c).isNull()) if c in samples.columns else missing
            rows = rows.unionByName(missing.select("sample", F.lit(f"no {c}").alias("problem")))
    again = samples.groupBy("sample").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sample", F.lit("repeated").alias("problem"))
    return rows.unionByName(again)


def library_problems(library: DataFrame, refs: DataFrame) -> DataFrame:
    """(reference, problem): unknown references, odd intervals, attributes with two values, shared barcodes."""
    known = library.join(refs.select(F.col("ref").alias("reference"), F.length("seq").alias("_n")), "reference", "left")
    bad = lambda condition, why: known.where(condition).select("reference", F.lit(why).alias("problem"))
    rows = bad("_n IS NULL", "not in the references")
    rows = rows.unionByName(bad("section_start > section_end", "starts after its end"))
    rows = rows.unionByName(bad("section_start < 1 OR section_end > _n", "outside the reference"))
    if "barcode_start" in library.columns:
        rows = rows.unionByName(bad("barcode_start IS NULL OR barcode_length < 1 OR barcode_start + barcode_length - 1 > _n", "odd barcode"))
        codes = known.select("reference", F.expr("(barcode_start, barcode_length)").alias("b")).distinct()
        rows = rows.unionByName(codes.groupBy("reference").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("reference", F.lit("two barcodes").alias("problem")))
    extra = [c for c in library.columns if c not in ("reference", *LIBRARY_PLACES)]
    for c in extra:
        rows = rows.unionByName(library.groupBy("reference").agg(F.countDistinct(c).alias("k")).where("k > 1").select("reference", F.lit(f"two values of {c}").alias("problem")))
    return rows.distinct()


def clean_library(library: DataFrame, refs: DataFrame) -> DataFrame:
    """One row per reference and interval, each named, with a `full` section for references that have none."""
    rows = library.dropDuplicates(["reference", "section_start", "section_end"])
    own = rows.join(refs.select(F.col("ref").alias("reference"), F.length("seq").alias("_n")), "reference")
    start, end = F.coalesce("section_start", F.lit(1)), F.coalesce("section_end", "_n")
    own = own.withColumn("section_start", start.cast("int")).withColumn("section_end", end.cast("int"))
    whole = (F.col("section_start") == 1) & (F.col("section_end") == F.col("_n"))
    own = own.withColumn("section", F.coalesce("section", F.when(whole, "full").otherwise(F.concat_ws("-", "section_start", "section_end"))))
    have = own.where(whole).select("reference").distinct()
    base = own.dropDuplicates(["reference"]).join(have, "reference", "left_anti")
    full = base.withColumn("section", F.lit("full")).withColumn("section_start", F.lit(1)).withColumn("section_end", F.col("_n"))
    return own.unionByName(full).drop("_n").dropDuplicates(["reference", "section_start", "section_end"])


def sample_documents(profiles: DataFrame, sample_columns: list[str], reference_columns: list[str], section_columns: list[str]) -> DataFrame:
    """(sample, document): JSON of a sample's tree sample, reference, section, cluster.

    Levels are maps built bottom up by three small aggregations; keys are sorted by name.
    """
    keys = ["sample", "reference", "section", "cluster"]
    leaf = [c for c in profiles.columns if c not in (*keys, *sample_columns, *reference_columns, *section_columns)]
    text = lambda cols: F.to_json(F.struct(*[F.col(c) for c in sorted(cols)])) if cols else F.lit("{}")

    def level(df: DataFrame, group: list[str], name: str, own: list[str]) -> DataFrame:
        quoted = F.to_json(F.array(F.col(name).cast("string")))
        entry = F.concat(quoted.substr(F.lit(2), F.length(quoted) - 2), F.lit(":"), F.col("_doc"))
        inner = F.array_join(F.sort_array(F.collect_list(entry)), ",")
        g = df.groupBy(*group).agg(inner.alias("_in"), F.min(text(own)).alias("_own"))
        head = F.expr("substring(_own, 2, length(_own) - 2)")
        return g.withColumn("_doc", F.concat(F.lit("{"), head, F.when(head != "", ",").otherwise(""), F.col("_in"), F.lit("}"))).drop("_in", "_own")

    d = profiles.withColumn("_doc", text(leaf))
    # a group carries the columns of the levels above, which are the same within it
    d = level(d, ["sample", "reference", "section", *sample_columns, *reference_columns], "cluster", section_columns)
    d = level(d, ["sample", "reference", *sample_columns], "section", reference_columns)
    d = level(d, ["sample"], "reference", sample_columns)
    return d.select("sample", F.col("_doc").alias("document"))


def flatten_documents(documents: DataFrame, text: str = "document") -> DataFrame:
    """One row per sample, reference, section, cluster of JSON documents: four keys and maps of texts.

    Scalars of a level belong to that level's rows only; what a reference lacks is absent, not another's.
    """
    level = "map<string,string>"
    objects = lambda m: F.filter(F.map_entries(m), lambda e: e["value"].startswith("{"))
    scalars = lambda m: F.map_filter(m, lambda _, v: ~v.startswith("{"))
    d = documents.select(F.from_json(text, level).alias("m"))
    d = d.select(F.col("m")["sample"].alias("sample"), scalars(F.col("m")).alias("sample_attributes"), F.explode(objects(F.col("m"))).alias("r"))
    d = d.select("sample", "sample_attributes", F.col("r.key").alias("reference"), F.from_json("r.value", level).alias("m"))
    d = d.select("sample", "sample_attributes", "reference", scalars(F.col("m")).alias("reference_attributes"), F.explode(objects(F.col("m"))).alias("s"))
    d = d.select("sample", "sample_attributes", "reference", "reference_attributes", F.col("s.key").alias("section"), F.from_json("s.value", level).alias("m"))
    d = d.select("sample", "sample_attributes", "reference", "reference_attributes", "section", scalars(F.col("m")).alias("section_attributes"), F.explode(objects(F.col("m"))).alias("c"))
    return d.select("sample", "sample_attributes", "reference", "reference_attributes", "section", "section_attributes", F.col("c.key").alias("cluster"), F.from_json("c.value", level).alias("values"))
