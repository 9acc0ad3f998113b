"""What the operators share: shared-folder tables, gapless numbering, blob exchange."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The ASCII white space of the contracts, `[\x20\x09-\x0D]`.
WHITE = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one where none is set and all runs in this process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="chemprobe-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


#: Whole texts go to Python in batches of at most so many rows and about so many bytes.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limits of an Arrow batch to BATCH, so that long texts do not add up in a worker."""
    for key, most in BATCH.items():
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Returns this process's freed memory to the system: a worker that waits for its next task would keep it."""
    pyarrow.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def _place(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in any store that Spark can write to."""
    at, fs = _place(spark, path)
    fs.delete(at, True)


#: Lists that take the folders of the tables that are being written.
_trackers: list[list[str]] = []


@contextmanager
def tracked() -> Iterator[list[str]]:
    """The folders of all tables that are written within the block."""
    made: list[str] = []
    _trackers.append(made)
    try:
        yield made
    finally:
        _trackers[:] = [t for t in _trackers if t is not made]


class Saved:
    """A table written to the shared folder: lineage is cut and any lost executor can reread it."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/chemprobe/{name}-{uuid.uuid4().hex}"
        self.schema = df.schema
        df.write.parquet(self.path)
        for made in _trackers:
            made.append(self.path)
        at, fs = _place(self.spark, self.path)
        fs.deleteOnExit(at)

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files, once everything that reads them has been written."""
        remove(self.spark, self.path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again; the files go when the session ends."""
    return Saved(df, name).df


#: A side of a join is broadcast up to so many rows of keys and numbers; beyond that both sides are dealt by key.
BROADCAST_KEYS = 500_000


def small_side(df: DataFrame) -> DataFrame:
    """`df`, a stored table of keys, as a broadcast side where it has at most BROADCAST_KEYS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def apart(docs: DataFrame, kept: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with all columns but `kept` under names of their place (c0, c1...), and what gives the old names back.

    So an operator's own column names never meet a table's.
    """
    inner = {c: c if c in kept else f"c{i}" for i, c in enumerate(docs.columns)}
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    renamed = docs.select(*[F.col(quoted(c)).alias(x) for c, x in inner.items()])
    return renamed, lambda df: df.select(*[F.col(x).alias(c) for c, x in inner.items()])


#: Nodes of a plan that give each stored row once at most.
_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


def _is_stored(docs: DataFrame) -> bool:
    if "_metadata" in docs.columns:
        return False
    node = docs._jdf.queryExecution().analyzed()
    while True:
        if node.getClass().getSimpleName() not in _ROW_BY_ROW or not node.deterministic():
            return False
        if node.children().isEmpty():
            break
        node = node.children().head()
    try:
        docs.select("_metadata.row_index", "_metadata.file_path")
    except AnalysisException:
        return False
    return True


def with_row_key(docs: DataFrame, name: str = "_rid") -> DataFrame:
    """`docs` with a long key of each row that is the same whenever and however the table is read again.

    Of stored Parquet rows it is the file's number and the row's place in it, whatever splits or executors
    read them. Any other table may give its rows in another order the next time, so it is written with
    its keys to the shared folder, and that is what is returned.
    """
    if not _is_stored(docs):
        return saved(docs.withColumn(name, F.monotonically_increasing_id()), "keyed")
    path = F.col("_metadata.file_path")
    # one row a file; the numbering is a window over file names alone
    files = docs.select(path.alias("_file")).distinct()
    files = saved(files.select("_file", (F.row_number().over(Window.orderBy("_file")) - 1).cast("long").alias("_no")), "files")
    keyed = docs.select("*", path.alias("_path"), F.col("_metadata.row_index").alias("_row")).join(small_side(files), F.col("_path") == F.col("_file"))
    return keyed.select(*[F.col(f"`{c}`") for c in docs.columns], (F.shiftleft("_no", 40) + F.col("_row")).alias(name))


def gapless(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds long column `name`: 0, 1, 2... in each `group` by `order`, without one task per group.

    Rows are dealt by range of (group, order), so that a hot group spreads over many tasks; each
    task numbers its own rows, and the small table of (task, group) counts gives the offsets. That
    table has at most tasks + groups rows. Nulls come first; rows equal in `order` get any order.
    """
    cols = [F.col(f"`{c}`").asc_nulls_first() for c in [*group, *order]]
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    ranged = ranged.withColumn("_at", F.monotonically_increasing_id())
    placed = saved(ranged, f"gapless-{name}")
    part = F.shiftright("_at", 33)
    placed = placed.withColumn("_part", part)
    counts = placed.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    keys = [F.col(f"`{c}`") for c in group]
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    if keys:
        before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    counts = counts.select(
        F.col("_part").alias("_p"), F.col("_first"), F.col("_before"), *[k.alias(f"_g{i}") for i, k in enumerate(keys)]
    )
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & k.eqNullSafe(F.col(f"_g{i}"))
    joined = placed.join(small_side(saved(counts, f"counts-{name}")), on)
    out = joined.withColumn(name, F.col("_at") - F.col("_first") + F.col("_before"))
    return out.drop("_at", "_part", "_p", "_first", "_before", *[f"_g{i}" for i in range(len(keys))])


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
