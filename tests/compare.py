"""Compares a query's rows with its SQL in DuckDB, without regard to order."""

import glob
import os

import duckdb


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def same(spark, query, sql, folder):
    frame = query(spark, folder)
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    found = con.sql(sql)
    columns = sorted(frame.columns)
    assert sorted(found.columns) == columns
    places = [found.columns.index(c) for c in columns]
    ours = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in frame.collect())
    theirs = sorted(repr(tuple(plain(r[i]) for i in places)) for r in found.fetchall())
    assert ours == theirs
