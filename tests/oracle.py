"""Comparison of a frame with DuckDB's answer on the same tables."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(pdf, columns):
    return sorted(tuple(None if v is None or v is pd.NA or v != v else v for v in r) for r in pdf[columns].astype(object).itertuples(index=False)) if len(pdf) else []


def same(con, df, sql):
    got, want = df.toPandas(), con.sql(sql).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    key = lambda r: tuple((v is None, str(v)) for v in r)
    a = sorted((tuple(None if v is None or v is pd.NA or v != v else v for v in r) for r in got[columns].astype(object).itertuples(index=False)), key=key)
    b = sorted((tuple(None if v is None or v is pd.NA or v != v else v for v in r) for r in want[columns].astype(object).itertuples(index=False)), key=key)
    assert a == b
