"""Compares a query's rows with those of its SQL in DuckDB."""

import math
import os
from collections import Counter

import duckdb

SMALL = "/root/testdata/sf0.001"


def connect(d: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for name in os.listdir(d):
        if name.endswith(".parquet"):
            path = os.path.join(d, name)
            path = f"{path}/*.parquet" if os.path.isdir(path) else path
            c.execute(f"create view {name[:-8]} as select * from '{path}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return f"{float(v):.9g}"


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def assert_same(df, sql: str, d: str = SMALL) -> None:
    got = connect(d).execute(sql)
    names = [x[0] for x in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, got.fetchall())
