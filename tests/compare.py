"""Rows of a query against rows of its SQL."""

import glob
import os

import duckdb


def database(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(df):
    columns = sorted(df.columns)
    return columns, sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())


def rows_of_sql(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    return columns, sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in result.fetchall())
