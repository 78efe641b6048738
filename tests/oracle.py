"""Runs a query and its SQL on the same tables and compares columns and rows."""

import decimal
import glob
import math
import os

import duckdb

DATA = os.environ.get("TEST_TABLES", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def compare(spark, query, sql, folder=DATA):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = query(spark, folder)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    r = con.execute(sql)
    names = [c[0] for c in r.description]
    at = [names.index(c) for c in sorted(names)]
    want = sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=repr)
    assert sorted(names) == columns
    assert got == want
