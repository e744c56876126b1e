"""Rows of a query against rows of its SQL, order aside."""

from __future__ import annotations

import datetime
import decimal
import glob

import duckdb


def connection(sf_dir: str):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        name = p.rsplit("/", 1)[1].removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{p}')")
    return con


def plain(v):
    if v is None or isinstance(v, bool | str | int):
        return v
    if isinstance(v, float | decimal.Decimal):
        f = round(float(v), 6)
        return int(f) if f.is_integer() else f
    if isinstance(v, datetime.datetime | datetime.date):
        return str(v)[:19]
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str:
    """'' if equal, else what differs."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got != want:
        only = [x for x in got if x not in set(want)][:3], [x for x in want if x not in set(got)][:3]
        return f"{len(got)} and {len(want)} rows; only in Spark {only[0]}, only in SQL {only[1]}"
    return ""
