"""Runs a query and its SQL on the same tables and compares the rows."""

import datetime
import decimal
import math
from collections import Counter

import duckdb
import numpy as np

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or value is ... or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool | str | bytes):
        return value
    if isinstance(value, bytearray):
        return bytes(value)
    if isinstance(value, float | decimal.Decimal | np.floating):
        return round(float(value), 6)
    if isinstance(value, int | np.integer):
        return float(value)
    if isinstance(value, datetime.datetime | datetime.date):
        return str(value)
    if isinstance(value, dict):
        return tuple(plain(x) for x in value.values())
    if hasattr(value, "asDict"):
        return tuple(plain(x) for x in value)
    return tuple(plain(x) for x in value)


def sql_rows(sql, sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    done = db.sql(sql)
    names = sorted(done.columns)
    at = [done.columns.index(n) for n in names]
    return names, Counter(tuple(plain(row[k]) for k in at) for row in done.fetchall())


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(row[n]) for n in names) for row in df.collect())


def differences(df, sql, sf_dir):
    a, b = spark_rows(df), sql_rows(sql, sf_dir)
    if a[0] != b[0]:
        return f"columns: {a[0]} and {b[0]}"
    if a[1] != b[1]:
        return f"rows: {sum(a[1].values())} and {sum(b[1].values())}; only Spark {list((a[1] - b[1]).items())[:3]}; only SQL {list((b[1] - a[1]).items())[:3]}"
    return ""
