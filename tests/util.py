"""Small hand-made tables."""

import datetime as dt

from pyspark.sql import functions as F

from barlake.operators.bronze import with_ingestion
from barlake.schemas import OHLC

DAY0 = dt.date(2024, 1, 1)
LOADED = dt.datetime(2024, 6, 1, 6, 0)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def bars(spark, closes, symbol="TEST", days=None):
    """Bars with the given closes on consecutive days, or on the given day numbers."""
    days = days if days is not None else range(len(closes))
    rows = [
        (day(n), symbol, float(c), float(c) + 1, float(c) - 1, float(c), float(c), 1_000_000)
        for n, c in zip(days, closes)
    ]
    return spark.createDataFrame(rows, OHLC)


def loaded(df, when=LOADED):
    return with_ingestion(df, when)


def versions(spark, rows):
    """(symbol, day number, close, load time, sequence) -> raw versions."""
    return spark.createDataFrame(
        [
            (day(n), s, c, c, c, c, c, 1, ts, ts.date(), seq)
            for s, n, c, ts, seq in rows
        ],
        "date date, symbol string, open double, high double, low double, close double, "
        "adjusted_close double, volume bigint, _ingestion_timestamp timestamp, "
        "_ingestion_date date, seq int",
    )


def column(df, name, order="date"):
    return [r[name] for r in df.orderBy(order).collect()]


def same_rows(a, b):
    """Equal as bags of rows, columns matched by name."""
    names = sorted(a.columns)
    assert names == sorted(b.columns)
    left = a.select(*names)
    right = b.select(*names)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def one(df):
    (row,) = df.collect()
    return row.asDict()


__all__ = ["DAY0", "F", "LOADED", "bars", "column", "day", "loaded", "one", "same_rows", "versions"]
