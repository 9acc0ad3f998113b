"""The corpus pipeline: quality rules, exact duplicates, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written as Parquet and read again as
the next stage's documents. All stages but the last return the columns of documents.

A stage's own tables go when a later stage begins, since its result has been written by then; those that
the documents given are still read from stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from chemprobe.llm._shared import Saved, remove, tracked
from chemprobe.llm.exact_dedup import keep_first_copies
from chemprobe.llm.ngram_join import keep_one_of_each
from chemprobe.llm.packing import pack
from chemprobe.llm.quality_rules import keep_good
from chemprobe.llm.suffix_dedup import remove_repeats

TOKENIZER = "byte_bpe_50k.json"


#: Folders of tables that finished stages have left.
_left: list[str] = []


def _tidy(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, which first deletes what the ones before it have left and then notes what it leaves."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        for folder in [f for f in _left if not any(f.rsplit("/", 1)[1] in file for file in read)]:
            remove(spark, folder)
            _left.remove(folder)
        with tracked() as made:
            out = stage(spark, docs, sf_dir)
        if stage.__name__ != "packing":  # nothing follows that could tell when its result has been read
            _left.extend(made)
        return out

    return run_stage


@_tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; thresholds adapt to the documents given."""
    return keep_good(docs)


@_tidy
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays: the longest as written, then the smallest doc_id."""
    return keep_first_copies(docs)


@_tidy
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the smallest doc_id stays."""
    return keep_one_of_each(docs)


@_tidy
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that begin elsewhere too are cut out of the texts."""
    return remove_repeats(docs)


@_tidy
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as token ids in sequences of 1024."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("ngram_join", near),
    ("suffix_dedup", passages),
    ("packing", packing),
]

#: Components of links and the packing's plan are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from `documents`. A stage's documents go once the next one's are written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        kept = Saved(stage(spark, docs, sf_dir), f"stage-{name}")
        if before:
            before.drop()
        docs, before = kept.df, kept
    return STAGES[-1][1](spark, docs, sf_dir)
