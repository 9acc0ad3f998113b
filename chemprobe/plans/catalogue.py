"""All queries of the engine by name, with their SQL."""

from __future__ import annotations

from chemprobe.plans import procedures, sequencing, studies, vectors

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _module in (vectors, sequencing, studies, procedures):
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)
