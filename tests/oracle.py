"""Run a query and its SQL over the same tables, and compare the rows."""

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    return repr(round(float(x), 9)) if isinstance(x, float) else str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(map(cell, r)) for r in df.itertuples(index=False)), key=str)


def same(spark, con, folder, query, sql):
    found = query(spark, folder)
    # whole numbers stay whole where some are null
    whole = {c: "Int64" for c, kind in found.dtypes if kind in ("int", "bigint")}
    got, wanted = found.toPandas().astype(whole), con.sql(sql).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)
    return len(got)
