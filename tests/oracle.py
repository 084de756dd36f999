"""Runs a registered query and its SQL twin and compares columns and rows, whatever the order."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, dt.date)):
        return v
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    names = [rel.columns[i] for i in order]
    return names, Counter(tuple(_plain(r[i]) for i in order) for r in rel.fetchall())


# Spark type -> DuckDB type, for the types that registered queries return.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df, con, sql):
    rel = con.sql(sql)
    want = dict(zip(rel.columns, map(str, rel.types)))
    return {n: (t, want.get(n)) for n, t in df.dtypes if TYPES.get(t, t) != want.get(n)}


def differences(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    if wrong := type_differences(df, con, sql):
        return f"types {wrong}"
    got_names, got = spark_rows(df)
    want_names, want = duck_rows(con, sql)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got != want:
        return f"{sum(got.values())} vs {sum(want.values())} rows; only Spark {list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}"
    return None
