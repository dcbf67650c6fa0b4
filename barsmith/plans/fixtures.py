"""Bar tables built from the driver's parquet tables (inputs of the test queries).

``bars_orders``: symbol = order priority, one bar per day, ticks = orders in
key order, price = total price, volume = sum of whole price units.
``bars_events``: symbol = event type, one bar per hour, ticks = events in id
order, price = value, volume = number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bars import bars_from_ticks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return bars_from_ticks(orders, symbol="o_orderpriority", ts="o_orderdate",
                           price="o_totalprice", volume=F.floor("o_totalprice"),
                           tick_id="o_orderkey", period="day")


def bars_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return bars_from_ticks(events, symbol="event_type", ts="ts", price="value",
                           volume=F.lit(1), tick_id="event_id", period="hour")
