"""Compare a registered query with its SQL counterpart, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((repr(tuple(_plain(r[i]) for i in order)) for r in rows))


def difference(spark, con, query, sql, sf_dir) -> str | None:
    """None when both give the same bag of rows, else a short description."""
    df = query(spark, sf_dir)
    ours = _canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = _canonical([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns differ: {ours[0]} / {theirs[0]}"
    if not theirs[1]:
        return "no rows to compare"
    if ours[1] == theirs[1]:
        return None
    extra = [r for r in ours[1] if r not in set(theirs[1])]
    lacking = [r for r in theirs[1] if r not in set(ours[1])]
    return (
        f"{len(ours[1])} / {len(theirs[1])} rows, {len(extra)} only in Spark {extra[:2]}, "
        f"{len(lacking)} only in SQL {lacking[:2]}"
    )
