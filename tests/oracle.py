"""Comparison of a query's rows with its DuckDB oracle."""

import os

import duckdb
import numpy as np

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and np.isnan(v)) or type(v).__name__ == "NAType":
        return "~"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating)) or type(v).__name__ == "Decimal":
        return f"{float(v) + 0.0:.9g}"
    return str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(map(_value, r)) for r in df.itertuples(index=False))


def same(spark, sf_dir, f, sql):
    got, want = f(spark, sf_dir).toPandas(), connect(sf_dir).execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
