"""The study table: one row per sample, reference, section and cluster, with arrays per position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemprobe.functions.stats import linear_fit, wilson

KEYS = ["sample", "reference", "section", "cluster"]
#: Array columns that a selection of positions cuts; text columns `sequence` and `structure` too.
ARRAYS = ["sub_A", "sub_C", "sub_G", "sub_T", "sub_N", "info", "del", "ins", "cov", "sub_rate"]
TEXTS = ["sequence", "structure"]


class Study:
    """A lazily evaluated study; every method gives a DataFrame."""

    def __init__(self, df: DataFrame, min_cov: int = 0, complete: bool = False):
        for key, default in (("section", "full"), ("cluster", "pop_avg")):
            if key not in df.columns:
                df = df.withColumn(key, F.lit(default))
        if "deltaG" in df.columns:
            df = df.withColumn("deltaG", F.coalesce(F.expr("try_cast(deltaG AS DOUBLE)"), F.lit(0.0)))
        df = df.withColumns({c: F.col(c).cast("string") for c in ("sample", "reference")}).where(F.col("min_cov") >= min_cov)
        self.df = complete_groups(df) if complete else df

    @classmethod
    def of(cls, *parts: DataFrame, **options) -> Study:
        """Several tables as one; columns that one lacks are null there."""
        df = parts[0]
        for p in parts[1:]:
            df = df.unionByName(p, allowMissingColumns=True)
        return cls(df, **options)

    def distinct(self, column: str, **equal) -> DataFrame:
        return select_rows(self.df, **equal).select(column).distinct()

    def get_df(self, base_index=None, base_type=None, base_pairing=None, min_cov: int | None = None, **equal) -> DataFrame:
        rows = select_rows(self.df, **equal)
        if min_cov is not None:
            rows = rows.where(F.col("min_cov") >= min_cov)
        return with_unique_id(select_positions(rows, base_index, base_type, base_pairing))

    def mutation_fraction(self, **k) -> DataFrame:
        """pos, base, paired and rate of each row."""
        return positions(self.get_df(**k), ["sub_rate"])

    def mutation_fraction_identity(self, **k) -> DataFrame:
        """Shares of each substituted base, with a Wilson interval of the rate (our choice of interval)."""
        p = positions(self.get_df(**k), ["sub_A", "sub_C", "sub_G", "sub_T", "sub_N", "info"])
        lo, hi = wilson(F.col("sub_N"), F.col("info"))
        shares = {f"rate_{b}": F.try_divide(F.col(f"sub_{b}"), F.col("info")) for b in "ACGT"}
        return p.withColumns(shares).withColumn("low", lo).withColumn("high", hi)

    def delta_g_vs_sub_rate(self, **k) -> DataFrame:
        rows = self.get_df(**k)
        return positions(rows, ["sub_rate"], ["deltaG"])

    def base_coverage(self, **k) -> DataFrame:
        return positions(self.get_df(**k), ["cov"])

    def variable_across_samples(self, variable: str, **k) -> DataFrame:
        """Rates by a sample attribute: one row per value, one column per position."""
        p = positions(self.get_df(**k), ["sub_rate"], [variable])
        return p.groupBy(variable).pivot("pos").agg(F.avg("sub_rate")).orderBy(variable)

    def hist_by_sample(self, **k) -> DataFrame:
        """Mutations per read, summed over a sample's rows; rows may have histograms of different lengths."""
        rows = select_rows(self.df, **k)
        return rows.select("sample", F.posexplode("sub_hist").alias("n_muts", "n")).groupBy("sample", "n_muts").agg(F.sum("n").alias("n_reads"))

    def hist(self, **k) -> DataFrame:
        return select_rows(self.df, **k).select(*KEYS, F.posexplode("sub_hist").alias("n_muts", "n_reads"))

    def reads_distribution(self, **k) -> DataFrame:
        return select_rows(self.df, **k).groupBy("num_aligned").agg(F.count(F.lit(1)).alias("n_references"))

    def mutations_in_barcodes(self, **k) -> DataFrame:
        return Study(self.df).hist_by_sample(**{**k, "section": "barcode"})

    def fraction_delta(self, first: dict, second: dict) -> DataFrame:
        """Rate of one row less another's by position; the base is `-` where they disagree."""
        side = lambda e, s: positions(select_rows(self.df, **e), ["sub_rate"]).select("pos", F.col("base").alias(f"base{s}"), F.col("sub_rate").alias(f"rate{s}"))
        base = F.when(F.col("base1") == F.col("base2"), F.col("base1")).otherwise("-")
        return side(first, 1).join(side(second, 2), "pos").select("pos", base.alias("base"), (F.col("rate1") - F.col("rate2")).alias("delta"))

    def compare_profiles(self, **k) -> DataFrame:
        """Fit of each unordered pair of rows: slope, intercept, r2, rmse over shared positions."""
        p = positions(self.get_df(**k), ["sub_rate"], ["unique_id"])
        a = p.select(F.col("unique_id").alias("id1"), "pos", F.col("sub_rate").alias("x"))
        b = p.select(F.col("unique_id").alias("id2"), "pos", F.col("sub_rate").alias("y"))
        return linear_fit(a.join(b, "pos").where("id1 < id2"), ["id1", "id2"], "x", "y")

    def figure_tables(self, **k) -> dict[str, DataFrame]:
        """The data of all figures that need no further choice, by name."""
        names = ["mutation_fraction", "mutation_fraction_identity", "base_coverage", "compare_profiles", "reads_distribution"]
        names += ["delta_g_vs_sub_rate"] if "deltaG" in self.df.columns else []
        names += ["hist", "hist_by_sample"] if "sub_hist" in self.df.columns else []
        return {name: getattr(self, name)(**k) for name in names if name != "reads_distribution" or "num_aligned" in self.df.columns}

    def add_sections(self, library: DataFrame) -> DataFrame:
        """`full` rows cut into the library's sections (reference, section, section_start, section_end)."""
        full = self.df.where(F.col("section") == "full").drop("section", "section_start", "section_end")
        rows = full.join(library.select("reference", "section", "section_start", "section_end"), "reference")
        for c in (*ARRAYS, *TEXTS):
            if c in rows.columns:
                rows = rows.withColumn(c, F.expr(f"{'substring' if c in TEXTS else 'slice'}({c}, section_start, section_end - section_start + 1)"))
        return self.df.unionByName(rows, allowMissingColumns=True).dropDuplicates(KEYS)


def select_rows(df: DataFrame, **equal) -> DataFrame:
    """Rows by column values: one value or a list of them; None asks nothing; an unknown column is an error."""
    for column, value in equal.items():
        if column not in df.columns:
            raise ValueError(f"no column {column}")
        if value is not None:
            df = df.where(F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(column) == value)
    return df


def complete_groups(df: DataFrame) -> DataFrame:
    """Rows whose reference, section and cluster every sample has."""
    k = KEYS[1:]
    samples = df.agg(F.countDistinct("sample").alias("_all"))
    full = df.groupBy(*k).agg(F.countDistinct("sample").alias("_n")).join(F.broadcast(samples)).where("_n = _all").select(*k)
    return df.join(full, k, "left_semi")


def select_positions(df: DataFrame, base_index=None, base_type=None, base_pairing: bool | None = None) -> DataFrame:
    """Cuts arrays to positions: by 1-based index, by a substring found once, by base, by pairing.

    Adds `index_selected`, the 1-based positions kept. Rows left without a position go.
    """
    if base_index is None and base_type is None and base_pairing is None:
        return df.withColumn("index_selected", F.sequence(F.lit(1), F.length("sequence")))
    idx = F.filter(F.sequence(F.lit(1), F.length("sequence")), lambda i: i > 0)
    if isinstance(base_index, str):
        once = F.size(F.split("sequence", base_index, -1)) == 2
        at = F.instr(F.col("sequence"), base_index)
        idx = F.when(once, F.sequence(at, at + len(base_index) - 1)).otherwise(F.array().cast("array<int>"))
    elif base_index is not None:
        wanted = [base_index] if isinstance(base_index, int) else list(base_index)
        idx = F.filter(F.array(*[F.lit(int(i)) for i in wanted]), lambda i: i <= F.length("sequence"))
    if base_type is not None:
        kinds = [base_type] if isinstance(base_type, str) else list(base_type)
        idx = F.filter(idx, lambda i: F.substring(F.col("sequence"), i, F.lit(1)).isin(kinds))
    if base_pairing is not None:
        idx = F.filter(idx, lambda i: F.substring(F.col("structure"), i, F.lit(1)).isin(["(", ")"] if base_pairing else ["."]))
    df = df.withColumn("index_selected", idx).where(F.size("index_selected") > 0)
    cuts = {c: F.expr(f"transform(index_selected, i -> `{c}`[i - 1])") for c in ARRAYS if c in df.columns}
    texts = {c: F.expr(f"array_join(transform(index_selected, i -> substring(`{c}`, i, 1)), '')") for c in TEXTS if c in df.columns}
    return df.withColumns(cuts | texts)


def with_unique_id(df: DataFrame) -> DataFrame:
    """Adds `unique_id`: the keys that have more than one value among the rows, joined by `_`."""
    found = df.agg(*[F.countDistinct(c).alias(c) for c in KEYS])
    many = found.select(*[(F.col(c) > 1).alias(f"_many_{c}") for c in KEYS])
    parts = F.concat_ws("_", *[F.when(F.col(f"_many_{c}"), F.col(c).cast("string")) for c in KEYS])
    return df.join(F.broadcast(many)).withColumn("unique_id", parts).drop(*[f"_many_{c}" for c in KEYS])


def positions(df: DataFrame, arrays: list[str], extra: list[str] | None = None) -> DataFrame:
    """One row per selected position: keys, `extra`, pos, base, paired and the arrays' values."""
    if "index_selected" not in df.columns:
        df = df.withColumn("index_selected", F.sequence(F.lit(1), F.length("sequence")))
    structure = F.split("structure", "") if "structure" in df.columns else F.transform("index_selected", lambda _: F.lit("."))
    zipped = F.arrays_zip(F.col("index_selected").alias("pos"), F.split("sequence", "").alias("base"), structure.alias("s"), *[F.col(a) for a in arrays])
    rows = df.select(*KEYS, *(extra or []), F.explode(zipped).alias("_x"))
    keep = [F.col(f"_x.{a}") for a in arrays]
    return rows.where(F.col("_x.pos").isNotNull()).select(*KEYS, *(extra or []), F.col("_x.pos"), F.col("_x.base"), F.col("_x.s").isin("(", ")").alias("paired"), *keep)
