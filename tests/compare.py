"""Comparison of a query with its SQL in DuckDB, independent of row order."""

import os

import pandas as pd

DATA = "/root/testdata/sf0.001"


def cell(v):
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if type(v).__name__ in ("bool", "bool_"):
        return bool(v)
    if hasattr(v, "dtype") and v.dtype.kind in "iuf" or isinstance(v, (int, float)):
        return round(float(v), 6)
    return v if isinstance(v, str) else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(repr(tuple(map(cell, r))) for r in df.astype(object).itertuples(index=False, name=None))


def oracle(sql, data=DATA):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return con.execute(sql).df()


def assert_same(found, sql, data=DATA):
    expected = oracle(sql, data)
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)
