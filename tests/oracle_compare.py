"""Shared helper: run a key in Spark and its oracle SQL in DuckDB, compare."""

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(cols, rows, order):
    idx = [cols.index(c) for c in order]
    return sorted((tuple(norm(r[i]) for i in idx) for r in rows), key=repr)


def compare(spark, con, key, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(scols) == sorted(ocols), (key, scols, ocols)
    order = sorted(scols)
    s, o = rows_of(scols, srows, order), rows_of(ocols, orows, order)
    assert len(s) == len(o), (key, len(s), len(o))
    assert s == o, (key, [x for x in s if x not in o][:2], [x for x in o if x not in s][:2])
    return len(s)
