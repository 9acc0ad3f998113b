"""What a run needs around its queries: locks on outputs, logging, outside programs, and where outputs lie."""

from __future__ import annotations

import logging
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, fields

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Outputs have a folder for each reference up to so many; more would be as many files, each of a few rows.
FOLDERS = 1000
LEVELS = (logging.WARNING, logging.INFO, logging.DEBUG)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path where driver and executors share files; a temporary one where all runs in this process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="chemprobe-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again, so that what reads it twice works it out once; it goes when the session ends."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def few(keys: DataFrame, most: int) -> bool:
    """Whether `keys` has at most so many distinct rows."""
    return keys.distinct().limit(most + 1).count() <= most


class OutputLock:
    """Holds an output path for one run: `with OutputLock(spark, path): ...`.

    The lock is a file beside the output, made by whatever store Spark writes to, which refuses to make one
    that is there; a path that is held is a FileExistsError. It goes when the block ends, errors included.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.file = path.rstrip("/") + ".lock"
        self.at = spark._jvm.org.apache.hadoop.fs.Path(self.file)
        self.fs = self.at.getFileSystem(spark._jsc.hadoopConfiguration())

    def __enter__(self) -> OutputLock:
        try:
            self.fs.create(self.at, False).close()
        except Py4JJavaError as error:
            if self.fs.exists(self.at):
                raise FileExistsError(f"{self.file}: another run writes there") from error
            raise
        return self

    def __exit__(self, *_) -> None:
        self.fs.delete(self.at, False)


def missing_programs(names: Iterable[str]) -> list[str]:
    """Those of the outside programs that are not on this machine's path."""
    return [n for n in names if shutil.which(n) is None]


def set_up_logging(verbose: int = 0, quiet: int = 0, file: str | None = None) -> logging.Logger:
    """The engine's logger: warnings by default, more or fewer by count; a file gets everything."""
    log = logging.getLogger("chemprobe")
    log.setLevel(logging.DEBUG)
    for handler in list(log.handlers):
        log.removeHandler(handler)
        handler.close()
    shown = logging.StreamHandler()
    shown.setLevel(LEVELS[min(verbose, 2)] if not quiet else logging.ERROR if quiet == 1 else logging.CRITICAL)
    log.addHandler(shown)
    if file:
        kept = logging.FileHandler(file)
        kept.setLevel(logging.DEBUG)
        log.addHandler(kept)
    for handler in log.handlers:
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    return log


@dataclass(frozen=True)
class OutputPath:
    """Where an output lies: top/step/sample/reference/end5-end3/name, as far as its parts are given."""

    top: str
    step: str
    sample: str
    ref: str | None = None
    end5: int | None = None
    end3: int | None = None
    name: str | None = None

    def __post_init__(self):
        given = [getattr(self, f.name) is not None for f in fields(self) if f.name != "name"]
        if given != sorted(given, reverse=True) or (self.end5 is None) != (self.end3 is None):
            raise ValueError("a part is given without the ones before it")
        for part in (self.step, self.sample, self.ref, self.name):
            if part is not None and (not part or "/" in part or part in (".", "..")):
                raise ValueError(f"no part of a path: {part!r}")
        if self.end5 is not None and not 1 <= self.end5 <= self.end3:
            raise ValueError(f"no section: {self.end5}-{self.end3}")

    def __str__(self) -> str:
        section = None if self.end5 is None else f"{self.end5}-{self.end3}"
        return "/".join(p for p in (self.top.rstrip("/"), self.step, self.sample, self.ref, section, self.name) if p is not None)

    @classmethod
    def parse(cls, top: str, path: str) -> OutputPath:
        """The parts of a path under `top`; ValueError if it is no such path."""
        start = top.rstrip("/") + "/"
        if not path.startswith(start):
            raise ValueError(f"{path} is not under {top}")
        step, sample, *rest = [*path[len(start) :].split("/"), ""]
        rest = [x for x in rest if x]
        ref = rest.pop(0) if rest else None
        ends: list[int | None] = [None, None]
        if rest and (cut := rest[0].split("-")) and len(cut) == 2 and all(x.isdigit() for x in cut):
            ends = [int(x) for x in cut]
            rest.pop(0)
        if len(rest) > 1:
            raise ValueError(f"too many parts: {path}")
        return cls(top, step, sample, ref, *ends, rest[0] if rest else None)
