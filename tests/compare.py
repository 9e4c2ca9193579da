"""Compares a query's rows with those of DuckDB's SQL over the same Parquet files."""

import glob
import math
import os

import duckdb


def connect(folder):
    c = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return str(int(v)) if v == int(v) else repr(round(v, 6))
    return str(v)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(r[n]) for n in names) for r in df.collect())


def rows_of_sql(c, sql):
    got = c.execute(sql)
    given = [d[0] for d in got.description]
    names = sorted(given)
    return names, sorted(tuple(plain(r[given.index(n)]) for n in names) for r in got.fetchall())
