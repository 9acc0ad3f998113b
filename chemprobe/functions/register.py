"""The bit queries, sequence helpers and CIGAR operations as functions of SQL.

They are SQL functions themselves, so Catalyst inlines their bodies: no Python runs in a query that names them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Name, arguments, result and body of each function.
SCALARS = {
    "mut_match": (
        "b INT, query INT, subsets BOOLEAN, supersets BOOLEAN",
        "BOOLEAN",
        "CASE WHEN query BETWEEN 0 AND 255 THEN (b = query AND query <> 0) OR (subsets AND b <> 0 AND (b | query) = query) "
        "OR (supersets AND IF(query = 0, b <> 0, (b & query) = query)) ELSE raise_error('a query is 0 to 255') END",
    ),
    "mut_overlap": ("b INT, query INT", "BOOLEAN", "(b & query) <> 0"),
    "mate_consensus": ("first INT, second INT", "INT", "IF((first & second) <> 0, first & second, first | second)"),
    "unsigned_byte": ("b INT", "INT", "b & 255"),
    "reverse_complement": ("s STRING", "STRING", "translate(reverse(s), 'ACGT', 'TGCA')"),
    "transcribe": ("s STRING", "STRING", "translate(s, 'T', 'U')"),
}
TABLES = {
    "cigar_operations": (
        "cigar STRING",
        "place INT, op STRING, length INT",
        "SELECT t.place, right(t.part, 1), CAST(left(t.part, length(t.part) - 1) AS INT) "
        "FROM (SELECT posexplode(regexp_extract_all(cigar_operations.cigar, '([0-9]+)([M=XDIS])', 0)) AS (place, part)) t",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session; returns their names."""
    for name, (arguments, result, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    for name, (arguments, columns, body) in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({columns}) RETURN {body}")
    return [*SCALARS, *TABLES]
