"""B1: ticks -> OHLCV bars per (symbol, period)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import nan_to_null


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_start(ts: str | Column, period: str) -> Column:
    """Start of the bar period. ``day`` gives a DATE, finer periods a TIMESTAMP."""
    if period == "day":
        return F.to_date(_c(ts))
    return F.date_trunc(period, _c(ts))


def bars_from_ticks(ticks: DataFrame, symbol: str | Column, ts: str | Column,
                    price: str | Column, volume: str | Column, tick_id: str | Column,
                    period: str = "day") -> DataFrame:
    """Aggregate ticks into bars ``(date, symbol, open, high, low, close, volume)``.

    open/close are the prices of the first/last tick by ``tick_id`` (unique,
    so the choice is deterministic). Every aggregate here is combinable, so
    Spark pre-aggregates map-side: a hot (symbol, period) key is reduced in
    each input partition before the shuffle and never lands in one task.
    """
    # A NaN price is a missing price: it is neither the high nor an open or close.
    price_c = nan_to_null(_c(price).cast("double"))
    id_c = F.when(price_c.isNotNull(), _c(tick_id))
    return (ticks
            .groupBy(period_start(ts, period).alias("date"), _c(symbol).alias("symbol"))
            .agg(F.min_by(price_c, id_c).alias("open"),
                 F.max(price_c).alias("high"),
                 F.min(price_c).alias("low"),
                 F.max_by(price_c, id_c).alias("close"),
                 F.sum(_c(volume)).cast("bigint").alias("volume")))


def price_volume_range(bars: DataFrame) -> DataFrame:
    """Q2: per symbol min(low), max(high), min/max(volume) and bar count."""
    return (bars.groupBy("symbol")
                .agg(F.count(F.lit(1)).alias("bar_count"),
                     F.min("low").alias("min_low"),
                     F.max("high").alias("max_high"),
                     F.min("volume").alias("min_volume"),
                     F.max("volume").alias("max_volume"),
                     F.min("date").alias("first_date"),
                     F.max("date").alias("last_date")))
