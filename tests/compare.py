"""Row-by-row comparison of a query with its SQL twin on DuckDB."""

import os

import duckdb
import pandas as pd


def rows(frame):
    def cell(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, (list, tuple)):
            return str([cell(x) for x in v])
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    names = sorted(frame.columns)
    return sorted((tuple(cell(v) for v in row) for row in frame[names].astype(object).itertuples(index=False)), key=str)


def on_duckdb(sql, sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    return con.execute(sql).df()
