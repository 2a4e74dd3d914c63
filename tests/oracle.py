"""Compares a query with its SQL on DuckDB, on the same tables."""

import glob
import os

import duckdb

DATA = "/root/testdata/sf0.001"


def tables(folder=DATA):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def assert_same(spark, make, sql, folder=DATA):
    df = make(spark, folder)
    columns = sorted(df.columns)
    ours = [tuple(r[c] for c in columns) for r in df.collect()]
    found = tables(folder).sql(sql)
    theirs = list(found.columns)
    assert sorted(theirs) == columns
    assert sorted(ours, key=str) == sorted((tuple(r[theirs.index(c)] for c in columns) for r in found.fetchall()), key=str)
