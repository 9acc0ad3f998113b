"""Report files of vector runs, the listing of alignment files, and small example tables."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.sources.vectors import bad_batches

STAMP = "%Y-%m-%d %H:%M:%S.%f"


def _listed(text: str) -> list[str]:
    return [x for x in text.split(", ") if x]


#: The fields of a report under their names in the file, and how their text is read.
FIELDS: dict[str, Callable[[str], Any]] = {
    "Reads Vectorized": int, "Reads with Errors": int, "Fraction Vectorized": float, "Batches": int, "Checksums": _listed,
    "Began": lambda x: datetime.strptime(x, STAMP), "Ended": lambda x: datetime.strptime(x, STAMP), "Time Taken": float, "Speed": float,
}
#: Fields that name where the report lies; they are optional in a file.
PLACES: dict[str, Callable[[str], Any]] = {"Sample": str, "Reference": str, "Section 5' End": int, "Section 3' End": int}

ALIGNMENTS = (".bam", ".sam", ".cram")


def write_report(report: DataFrame, path: str, places: Mapping[str, Any] | None = None) -> None:
    """Writes a one-row report as one JSON object of texts, with the fields that name its place."""
    named = [F.lit(str(v)).alias(k) for k, v in (places or {}).items()]
    row = F.to_json(F.struct(*named, *[F.col(f"`{c}`").cast("string").alias(c) for c in report.columns]))
    report.select(row.alias("value")).coalesce(1).write.mode("error").text(path)


def read_report(spark: SparkSession, path: str) -> dict[str, Any]:
    """A report's fields with their types. A field that is missing, unknown or odd is a ValueError."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{len(rows)} reports in {path}")
    raw = json.loads(rows[0]["value"])
    known = FIELDS | PLACES
    if odd := [k for k in raw if k not in known] + [k for k in FIELDS if k not in raw]:
        raise ValueError(f"unknown or missing fields: {odd}")
    try:
        return {k: known[k](v) for k, v in raw.items()}
    except (TypeError, ValueError) as error:
        raise ValueError(f"an odd field in {path}: {error}") from error


def check_report(spark: SparkSession, report: Mapping[str, Any], batches: str, places: Mapping[str, Any] | None = None) -> None:
    """Compares a report with where it lies and with its batch files.

    A place that differs is a ValueError, a batch without a file a FileNotFoundError, a file that is not the
    one listed a ValueError. Files are summed where Spark reads them.
    """
    for name, value in (places or {}).items():
        if report.get(name) != value:
            raise ValueError(f"{name} is {report.get(name)!r} in the report and {value!r} in its path")
    if len(report["Checksums"]) != report["Batches"]:
        raise ValueError(f"{report['Batches']} batches with {len(report['Checksums'])} checksums")
    found = spark.read.format("binaryFile").load(batches).count()
    if found < report["Batches"]:
        raise FileNotFoundError(f"{report['Batches'] - found} batches are missing from {batches}")
    if bad := bad_batches(spark, batches, report["Checksums"]).head(3):
        raise ValueError(f"batches that are not the ones listed: {[r['checksum'] for r in bad]}")


def list_alignments(paths: Iterable[str], extensions: tuple[str, ...] = ALIGNMENTS) -> list[str]:
    """Alignment files among files and folders of this machine, sorted.

    A path that does not exist is a FileNotFoundError; a file that is named twice, or named though it has
    another ending, a ValueError. Other files in a folder are passed over.
    """
    found: list[str] = []
    for path in paths:
        if os.path.isdir(path):
            found += [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.endswith(extensions)]
        elif not os.path.exists(path):
            raise FileNotFoundError(path)
        elif not path.endswith(extensions):
            raise ValueError(f"{path} does not end in {', '.join(extensions)}")
        else:
            found.append(path)
    real = [os.path.realpath(f) for f in found]
    if twice := sorted({f for f in real if real.count(f) > 1}):
        raise ValueError(f"named twice: {twice}")
    return sorted(found)


def read_feather(spark: SparkSession, path: str) -> DataFrame:
    """A small example table in Feather, read on the driver."""
    from pyarrow import feather

    return spark.createDataFrame(feather.read_table(path))
