"""Spark-vs-DuckDB comparison used by the tests (same idea as the driver's gate).

Columns are sorted by name; rows are compared as multisets of canonical
value strings, plus row count and column names.
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral_value() else str(v.normalize())
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in cols]).collect()
    return cols, collections.Counter(tuple(canon(x) for x in r) for r in rows)


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    return cols, collections.Counter(tuple(canon(r[i]) for i in order) for r in data)


def compare(spark_df, con, sql) -> tuple[bool, str]:
    sc, sr = spark_rows(spark_df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    ns, nd = sum(sr.values()), sum(dr.values())
    if ns != nd:
        return False, f"row count spark={ns} duck={nd}"
    if sr != dr:
        only_s = list((sr - dr).items())[:3]
        only_d = list((dr - sr).items())[:3]
        return False, f"values differ ({ns} rows): spark-only={only_s} duck-only={only_d}"
    return True, f"{ns} rows"
