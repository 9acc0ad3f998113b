"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1); BENCH_CPUS: local cores (default 8).
Each query runs once to warm up and is then timed while its whole result is written to nowhere.
`vectors_per_sec` is the rate of turning records over a 30-base section into vectors.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from chemprobe.operators.vectorize import vectorize  # noqa: E402
from chemprobe.plans import catalogue  # noqa: E402
from chemprobe.session import get_session  # noqa: E402

HEADLINE = [
    "profile_by_pos", "bit_either", "muts_per_read", "sub_hist", "unique_patterns", "preprocess_report", "filter_close_muts", "mate_consensus",
    "cluster_rates", "best_alignment", "demux_exact", "demux_mismatch", "demux_report", "study_compare_pairs", "profile_from_arrays",
]
RECORDS = 300_000


def spent(df) -> float:
    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def vector_rate(spark) -> float:
    ref = "ACGTTGCAACGGATCCGATACATTGACCGT"
    n = F.col("id")
    turn = F.expr("concat(substr(s, 1, cast(id % 30 as int)), translate(substr(s, cast(id % 30 as int) + 1, 1), 'ACGT', 'CGTA'), substr(s, cast(id % 30 as int) + 2))")
    sam = spark.range(RECORDS, numPartitions=8).withColumn("s", F.lit(ref)).select(
        F.concat(F.lit("q"), n.cast("string")).alias("qname"), F.lit(0).alias("flag"), F.lit("r").alias("rname"), F.lit(1).alias("pos"), F.lit("30M").alias("cigar"), turn.alias("seq"), F.lit("I" * 30).alias("qual")
    )
    sections = spark.createDataFrame([("r", "full", 1, 30, ref)], "ref string, section string, end5 int, end3 int, section_seq string")
    spent(vectorize(sam.limit(1000), sections))
    return RECORDS / spent(vectorize(sam, sections))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus), spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        spent(catalogue.QUERIES[name](spark, sf))
        times[name] = round(spent(catalogue.QUERIES[name](spark, sf)), 3)
    rate = vector_rate(spark)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "vectors_per_sec": round(rate, 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
