"""Rows of a DataFrame and of DuckDB SQL in one form."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def form(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    return f"{v + 0.0:.5f}" if isinstance(v, float) else str(v)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(form(r[c]) for c in columns) for r in df.collect())


def duck_rows(text, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    r = con.execute(text)
    names = [d[0] for d in r.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(form(row[i]) for i in order) for row in r.fetchall())
