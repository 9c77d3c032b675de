"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, sql: str, con) -> tuple[bool, str]:
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if got != want:
        extra, missing = got - want, want - got
        lines = [f"rows {sum(got.values())} vs {sum(want.values())}, {sum(extra.values())} differ", str(got_cols)]
        key = lambda r: tuple(str(x) for x in r)
        for tag, part in (("spark", extra), ("sql  ", missing)):
            lines += [f"{tag} {r}" for r in sorted(part, key=key)[:4]]
        return False, "\n".join(lines)
    return True, f"{sum(got.values())} rows"
