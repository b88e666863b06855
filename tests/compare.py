"""Rows of a query against rows of its SQL, whatever the order."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool | str):
        return v
    try:
        return round(float(v), 7)
    except (TypeError, ValueError):
        return str(v)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted(repr([_plain(r[c]) for c in names]) for r in df.collect())


def rows_of_sql(con, sql):
    got = con.sql(sql)
    names = sorted(got.columns)
    at = [got.columns.index(c) for c in names]
    return names, sorted(repr([_plain(r[i]) for i in at]) for r in got.fetchall())
