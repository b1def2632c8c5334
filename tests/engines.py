"""Running a registered query in both engines and comparing whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    number = float(value)
    return "nan" if math.isnan(number) else number + 0.0


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]

    def place(row):
        return [("", "") if x is None else (str(type(x)), x) for x in row]

    return sorted(columns), sorted(out, key=place)


def in_spark(df):
    return rows_of(df.columns, df.collect())


def in_duckdb(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())
