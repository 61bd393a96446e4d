"""Compares a query with its SQL."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(value):
    return round(value, 6) if isinstance(value, float) else str(value) if not isinstance(value, (int, str, bool, type(None))) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted((tuple(normal(r[k]) for k in order) for r in rows), key=repr)


def sql_rows(sql, folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])
