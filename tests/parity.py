"""Comparing a query's rows with DuckDB's for its SQL."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def compare(spark, sf, query, sql):
    df = query(spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(normal(x) for x in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=str)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = db.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted((tuple(normal(r[i]) for i in at) for r in found.fetchall()), key=str)
    assert got == want
