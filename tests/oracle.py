"""Comparing a query with its SQL in a second engine."""
import datetime
import decimal
import os
from collections import Counter

import duckdb

SF = "/root/testdata/sf0.001"


def connect(folder=SF):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(folder):
        p = f"{folder}/{f}"
        c.execute(f"create view {f.split('.')[0]} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 5)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def same(spark, queries, sql, name, folder=SF):
    df = queries[name](spark, folder)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    res = connect(folder).sql(sql[name])
    at = [res.columns.index(c) for c in cols]
    want = Counter(tuple(plain(r[i]) for i in at) for r in res.fetchall())
    assert sorted(res.columns) == cols
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
