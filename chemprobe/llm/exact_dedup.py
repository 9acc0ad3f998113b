"""Exact duplicates by deterministic block naming.

Each text, without white space, is cut into blocks of a fixed size. The distinct blocks are sorted and
get integer names; then adjacent pairs of names are named in the same way, level by level, until each
document has one name. Names stand for contents one to one, so equal names mean equal texts: there is
no hash that could collide.

A block (or pair of names) that occurs once makes its document unlike any other, so such a document
leaves the recursion at once, under the name UNIQUE. Blocks whose 64-bit hash occurs once occur once
themselves, so only the others are sorted, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.llm._shared import WHITE, Saved, apart, saved, small_side, text_or_empty, with_row_key

BLOCK_BYTES = 4096
#: Stands for whatever occurs in one place only.
UNIQUE = -2
#: Stands for the missing partner of an odd last name.
NOTHING = -1


def _named(rows: DataFrame, key: list[str]) -> DataFrame:
    """The keys that occur at least twice, with integer names: their places in sorted order.

    Sorting is by partition, and a key lies in one partition only, so a name (partition, place) is
    one key's alone. Partial counts on each task keep a frequent key from meeting in one.
    """
    found = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return found.sortWithinPartitions(*key).withColumn("_name", F.monotonically_increasing_id()).drop("_n")


def identities(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (_rid, doc_id, text): _rid, doc_id, n_chars, text_sha256, levels and name.

    Rows with equal (levels, name), UNIQUE aside, have equal texts. Null counts as the empty text.
    The number of rounds is the logarithm of the longest text's blocks.
    """
    text = text_or_empty("text")
    norm = F.translate(text, WHITE, "")
    base = docs.select("_rid", "doc_id", F.length(text).cast("long").alias("n_chars"), norm.alias("norm"))
    base = base.withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))
    size = F.octet_length("norm")
    blocks = base.withColumn("_nb", F.greatest(F.ceil(size / F.lit(BLOCK_BYTES)), F.lit(1)).cast("int"))
    at = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_idx")
    about = ["_rid", "doc_id", "n_chars", "text_sha256", "_nb"]
    blocks = blocks.select(*about, F.col("norm").cast("binary").alias("b"), at)
    block = F.substring("b", F.col("_idx") * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES))
    blocks = blocks.select(*about, "_idx", block.alias("_block")).withColumn("_hash", F.xxhash64("_block"))

    hashes = blocks.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    hashes = saved(hashes, "block-hashes")
    again = blocks.join(small_side(hashes), "_hash", "left_semi")
    # the names are written first: a join of two plain exchanges can split a hot block's partition
    names = saved(_named(again.select("_block"), ["_block"]), "block-names")
    named = again.join(names, "_block", "left").select(*about, "_idx", F.coalesce("_name", F.lit(UNIQUE)).alias("_name"))
    once = blocks.join(small_side(hashes), "_hash", "left_anti").select(*about, "_idx", F.lit(UNIQUE).cast("long").alias("_name"))
    first = Saved(named.unionByName(once), "blocks")
    rows = first.df.select("_rid", "_nb", "_idx", "_name")

    most = rows.agg(F.max("_nb")).first()[0] or 1
    done, levels, left = [rows.where("_nb = 1").select("_rid", F.lit(0).alias("levels"), "_name")], 0, rows.where("_nb > 1")
    while most > 1:
        levels, most = levels + 1, (most + 1) // 2
        half = F.shiftright("_idx", 1)
        side = lambda k: F.max(F.when(F.col("_idx") % 2 == k, F.col("_name")))
        pairs = left.groupBy("_rid", F.shiftright(F.col("_nb") + 1, 1).alias("_nb"), half.alias("_idx")).agg(
            side(0).alias("_l"), F.coalesce(side(1), F.lit(NOTHING)).alias("_r")
        )
        known = (F.col("_l") != UNIQUE) & (F.col("_r") != UNIQUE)
        pairs = saved(pairs, f"pairs-{levels}")
        names = saved(_named(pairs.where(known).select("_l", "_r"), ["_l", "_r"]), f"pair-names-{levels}")
        joined = pairs.join(names, ["_l", "_r"], "left")
        named = saved(joined.select("_rid", "_nb", "_idx", F.coalesce("_name", F.lit(UNIQUE)).alias("_name")), f"names-{levels}")
        done.append(named.where("_nb = 1").select("_rid", F.lit(levels).alias("levels"), "_name"))
        left = named.where("_nb > 1")
    names = done[0]
    for part in done[1:]:
        names = names.unionByName(part)
    about = first.df.where("_idx = 0").select("_rid", "doc_id", "n_chars", "text_sha256")
    return about.join(names.withColumnRenamed("_name", "name"), "_rid")


def _marked(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (_rid, doc_id, text): _rid, doc_id, keep_id, group_size, kept, text_sha256."""
    rows = saved(identities(docs), "identities")
    alone = rows.where(F.col("name") == UNIQUE)
    shared = rows.where(F.col("name") != UNIQUE)
    rank = F.struct((-F.col("n_chars")).alias("c"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("doc_id"), F.col("_rid").alias("rid"))
    # written first, as the names are: a hot group's rows can then be split over tasks
    best = saved(shared.groupBy("levels", "name").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size")), "best-copies")
    grouped = shared.join(small_side(best), ["levels", "name"]).select(
        "_rid", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("_rid") == F.col("best.rid")).alias("kept"), "text_sha256"
    )
    single = alone.select("_rid", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return grouped.unionByName(single)


def mark_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts, the row with the most code points stays, then the smallest doc_id (null last),
    then the first one stored, so that exactly one of repeated rows stays. Null and empty texts, and
    texts of white space only, are one group. An empty table gives an empty result.
    """
    return _marked(with_row_key(docs.select("doc_id", "text"))).drop("_rid")


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that `mark_duplicates` keeps, with their columns as they were.

    Only the keys of the rows that go are joined with the table, so texts move only where those keys are
    too many to be sent to every task. Repeats of an id are rows like any others.
    """
    inner, restore = apart(docs, ("doc_id", "text"))
    keyed = with_row_key(inner)
    gone = saved(_marked(keyed.select("_rid", "doc_id", "text")).where("NOT kept").select("_rid"), "dropped-copies")
    return restore(keyed.join(small_side(gone), "_rid", "left_anti"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts, and whether it stays."""
    return mark_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP8_SQL = """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""
