"""Small hand-written bar fixtures."""

from __future__ import annotations

import datetime as dt

from barsmith.schema import BAR


def day(i: int, start: dt.date = dt.date(2024, 1, 1)) -> dt.date:
    return start + dt.timedelta(days=i)


def bars(spark, rows):
    """rows: (day_index, symbol, open, high, low, close, volume)."""
    return spark.createDataFrame([(day(d), s, o, h, l, c, v) for d, s, o, h, l, c, v in rows], BAR)


def closes(spark, symbol, values, volume=1000, start=0):
    """Bars whose open/high/low equal the close (flat bars) unless given."""
    return bars(spark, [(start + i, symbol, c, c, c, c, volume) for i, c in enumerate(values)])


def ohlc(spark, symbol, series, start=0):
    """series: list of (open, high, low, close, volume)."""
    return bars(spark, [(start + i, symbol, o, h, l, c, v) for i, (o, h, l, c, v) in enumerate(series)])


def by_symbol_date(df):
    return {(r["symbol"], r["date"]): r.asDict() for r in df.collect()}
