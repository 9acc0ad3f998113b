"""Quality rules with adaptive thresholds from mergeable quantile sketches. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chemprobe.llm._shared import apart, saved

MIN_WORDS = 50
#: Values keep this many significant bits in a sketch: an error under 1/64 of the value.
SKETCH_BITS = 7
#: Of each measure (in thousandths), the percentile that its threshold is taken from. Up to a tenth of a source
#: may be symbol junk; lines and words that repeat, and capitals, are common in sound texts, so their tails are shorter.
MEASURES = {"symbols": 90, "dup_lines": 98, "repeats": 98, "capitals": 98}
#: A threshold is so many times that percentile.
TIMES = 2
#: A group's sketch is blended with so many rows' worth of its language's, and that one's with the whole's.
PRIOR = 25
#: Blended counts are whole numbers of this fraction of a row.
_SCALE = 1000

RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

#: Thresholds are broadcast up to so many groups; beyond that they are joined by group.
BROADCAST_GROUPS = 50_000

_SPACE = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words within 3-word windows that occur twice or more in the text.

    The windows' 64-bit hashes are sorted with their places; equal neighbours are repeats. The places
    of repeats, sorted, then cover up to three words each. O(n log n) for texts of any length.
    """

    def windows(h: Column) -> Column:
        n = F.size(h)
        return F.when(
            n >= 4,
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(h[i], h[i + 1], h[i + 2]).alias("h"), i.alias("i"))
                )
            ),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

    def repeated(s: Column) -> Column:
        same = lambda x, k, d: F.coalesce(F.get(s, k + d)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, k, -1) | same(x, k, 1)), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        widths = F.transform(at, lambda x, k: F.coalesce(F.least(F.lit(3), F.get(at, k + 1) - x), F.lit(3)))
        return F.aggregate(widths, F.lit(0).cast("long"), lambda a, x: a + x)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: let(windows(h), lambda s: let(repeated(s), covered)))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base measures of every whole text: a map without a shuffle.

    Null and empty texts have no words and zeros. Existing columns of the same names are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.ltrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    both = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.length(F.array_join(w, "")).cast("long").alias("chars"),
            _repeat_words(w).alias("rep"),
        ),
    )
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d")))
    df = docs.withColumn("__w", both).withColumn("__l", of_lines)
    return df.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in RESULTS],
        F.col("__w.n").alias("n_words"),
        F.col("__w.chars").alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.col("__l.n") - F.col("__l.d")).alias("n_dup_lines"),
        F.col("__w.rep").alias("n_repeat_words"),
        F.col("__l.n").alias("__lines"),
        F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("__capitals"),
    )


def _rates() -> dict[str, Column]:
    per = lambda a, b: F.expr(f"({a} * 1000) div greatest({b}, 1)")
    return {
        "symbols": per("n_symbols", "word_chars"),
        "dup_lines": per("n_dup_lines", "__lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "capitals": per("__capitals", "word_chars"),
    }


def sketch_value(v: str) -> Column:
    """A non-negative value cut to SKETCH_BITS significant bits: the sketch's bucket."""
    shift = f"greatest(length(bin({v})) - {SKETCH_BITS}, 0)"
    return F.expr(f"shiftleft(shiftright({v}, {shift}), {shift})")


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Quantile sketches as rows (groups, measure, bucket, n). Sketches merge by adding n.

    Buckets have a fixed relative width, so a sketch has a few hundred rows at most whatever the
    input, and partial sums on each task keep a hot group from meeting in one.
    """
    pairs = [F.struct(F.lit(m).alias("measure"), F.col(f"__r_{m}").alias("v")) for m in MEASURES]
    long = measured.select(*groups, F.explode(F.array(*pairs)).alias("p")).select(*groups, "p.measure", "p.v")
    return long.select(*groups, "measure", sketch_value("v").alias("bucket")).groupBy(*groups, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _blended(sketch: DataFrame, keys: list[str], wider: DataFrame, wider_keys: list[str]) -> DataFrame:
    """(keys, measure, bucket, n): each group's counts with PRIOR rows spread as the wider group's are.

    `wider` has counts n of its own in any unit; the result counts in fractions of a row. A group's own rows
    outweigh the prior as it grows, with no size at which the rule changes.
    """
    own = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    total = wider.groupBy(*wider_keys, "measure").agg(F.sum("n").alias("t"))
    share = wider.join(total, [*wider_keys, "measure"]).select(*wider_keys, "measure", "bucket", F.expr(f"({PRIOR * _SCALE} * n) div t").alias("prior"))
    every = own.select(*keys, "measure").distinct().join(share, [*wider_keys, "measure"])
    both = every.join(own, [*keys, "measure", "bucket"], "left")
    return both.select(*keys, "measure", "bucket", (F.coalesce("n", F.lit(0)) * _SCALE + F.col("prior")).alias("n"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): the most that each measure may be.

    TIMES the measure's percentile in the group's own sketch, which is blended with its language's by size.
    """
    whole = sketch.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))
    langs = _blended(sketch, ["__glang"], whole, [])
    own = _blended(sketch, ["__glang", "__gsource"], langs, ["__glang"])
    w = Window.partitionBy("__glang", "__gsource", "measure")
    cum = own.withColumn("c", F.sum("n").over(w.orderBy("bucket"))).withColumn("t", F.sum("n").over(w))
    percent = F.create_map(*[x for m, p in MEASURES.items() for x in (F.lit(m), F.lit(p))])[F.col("measure")]
    most = lambda m: F.min(F.when((F.col("measure") == m) & (F.col("c") * 100 >= F.col("t") * percent), TIMES * F.col("bucket")))
    return cum.groupBy("__glang", "__gsource").agg(*[most(m).alias(f"most_{m}") for m in MEASURES])


_NEEDED = ("doc_id", "text", "lang", "source")


def _judged(inner: DataFrame, name: str, texts: bool = True) -> DataFrame:
    """`inner` with the measures, base_failed and kept; the texts are left out where they are not needed.

    The measured rows are written to the shared folder once: neither the sketches nor the join with the
    thresholds read or move a text again.
    """
    m = measures(inner)
    m = saved(m if texts else m.drop("text"), name)
    m = m.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    for rate, value in _rates().items():
        m = m.withColumn(f"__r_{rate}", value)
    # a prefix keeps null apart from every value
    for key in ("lang", "source"):
        m = m.withColumn(f"__g{key}", F.coalesce(F.concat(F.lit("="), key), F.lit("")))
    sketch = saved(sketches(m.where(~F.col("base_failed")), ["__glang", "__gsource"]), "quality-sketches")
    limits = saved(thresholds(sketch), "quality-thresholds")
    # a few numbers a group: sent to every task while that is small, so that a hot group is not dealt to one
    limits = F.broadcast(limits) if limits.count() <= BROADCAST_GROUPS else limits
    joined = m.join(limits, ["__glang", "__gsource"], "left")
    within = F.lit(True)
    for rate in MEASURES:
        within = within & (F.col(f"__r_{rate}") <= F.coalesce(F.col(f"most_{rate}"), F.lit(2**62)))
    return joined.withColumn("kept", ~F.col("base_failed") & within)


def judge(docs: DataFrame) -> DataFrame:
    """The base measures, `base_failed` and `kept` of every row; needs doc_id, text, lang and source.

    Sketches are built from the rows that pass the base rules. Null lang or source is a group of its own. A
    text without words, null included, fails the base rules. Repeated rows are judged alike, each one; an
    empty table gives an empty result. Other columns stay, those named as a result are replaced.
    """
    others = docs.select(*[f"`{c}`" for c in docs.columns if c not in RESULTS])
    inner, _ = apart(others, _NEEDED)
    out = _judged(inner, "quality-measures", texts=False)
    renames = dict(zip(inner.columns, others.columns))
    return out.select(*[F.col(i).alias(c) for i, c in renames.items() if c != "text"], *RESULTS)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with their columns as they were.

    The measured rows are written with their texts, so that the verdict is a filter of them: no text is
    shuffled and no row has to be told from another. Null and empty texts go, as do those of few words;
    repeated rows stay or go together. An empty table stays empty.
    """
    inner, restore = apart(docs, _NEEDED)
    return restore(_judged(inner, "quality-measured").where("kept"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base measures and verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return judge(docs).select("doc_id", *RESULTS)


def _sql() -> str:
    """DuckDB SQL for `op3_quality_rules`, by the same sketches."""
    white = "[\\x20\\x09-\\x0D]"
    cut = "CASE WHEN {v} >= 128 THEN ({v} >> (length(bin({v})) - 7)) << (length(bin({v})) - 7) ELSE {v} END"
    rates = {
        "symbols": "n_symbols * 1000 // greatest(word_chars, 1)", "dup_lines": "n_dup_lines * 1000 // greatest(n_lines, 1)",
        "repeats": "n_repeat_words * 1000 // greatest(n_words, 1)", "capitals": "n_capitals * 1000 // greatest(word_chars, 1)",
    }
    long = " UNION ALL ".join(f"SELECT l, s, '{m}' AS measure, CAST({r} AS BIGINT) AS v FROM base WHERE NOT base_failed" for m, r in rates.items())
    percent = " ".join(f"WHEN '{m}' THEN {p}" for m, p in MEASURES.items())

    def blended(name: str, keys: str, wider: str, wider_keys: str) -> str:
        by = f"{wider_keys}, " if wider_keys else ""
        return (
            f"{name}p AS (SELECT {by}measure, bucket, CAST(({PRIOR * _SCALE} * n) // sum(n) OVER (PARTITION BY {by}measure) AS BIGINT) AS prior FROM {wider}), "
            f"{name}o AS (SELECT {keys}, measure, bucket, CAST(sum(n) AS BIGINT) AS n FROM sk GROUP BY ALL), "
            f"{name} AS (SELECT {keys}, measure, bucket, coalesce(n, 0) * {_SCALE} + prior AS n FROM (SELECT DISTINCT {keys}, measure FROM {name}o) JOIN {name}p USING ({by}measure) LEFT JOIN {name}o USING ({keys}, measure, bucket))"
        )

    within = " AND ".join(f"({r}) <= coalesce(max(CASE WHEN measure = '{m}' THEN most END), 4611686018427387904)" for m, r in rates.items())
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, coalesce('=' || lang, '') AS l, coalesce('=' || source, '') AS s FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(x, '{white}+'), lambda y: y <> '') AS ws,
  list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
tri AS (SELECT doc_id, i, ws[i:i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k FROM tri) WHERE k > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, (VALUES (0), (1), (2)) o(j) GROUP BY 1),
base0 AS (SELECT w.doc_id, l, s, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
  (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
  len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cov USING (doc_id)),
base AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base0),
long AS ({long}),
sk AS (SELECT l, s, measure, {cut.format(v="v")} AS bucket, count(*)::BIGINT AS n FROM long GROUP BY ALL),
whole AS (SELECT measure, bucket, CAST(sum(n) AS BIGINT) AS n FROM sk GROUP BY ALL),
{blended("lang", "l", "whole", "")}, {blended("own", "l, s", "lang", "l")},
cum AS (SELECT l, s, measure, bucket, sum(n) OVER (PARTITION BY l, s, measure ORDER BY bucket) AS c, sum(n) OVER (PARTITION BY l, s, measure) AS t FROM own),
lim AS (SELECT l, s, measure, {TIMES} * min(bucket) AS most FROM cum WHERE c * 100 >= t * CASE measure {percent} END GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {within} AS kept
FROM base LEFT JOIN lim USING (l, s) GROUP BY doc_id, n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words, base_failed
"""


OP3_SQL = _sql()
