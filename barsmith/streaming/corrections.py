"""Bars of a tick stream that late ticks correct instead of being dropped.

One query, ``foreachBatch``: every micro-batch of ticks is reduced to partial
bars, one row per (symbol, period) with what can be merged later: first and
last priced tick, high, low, volume, number of ticks. A tick whose period had ended
before the watermark (the newest time of all *earlier* batches, less the
allowed lateness) is late: it is written to an output of its own and counted, and its
partial bar is marked.

* :func:`published_bars`: what was final without the late ticks.
* :func:`corrections`: the bars that late ticks touch, recomputed from all partials.
* :func:`corrected_bars`: both merged, equal to the bars of one batch over all ticks.
* :func:`merge_corrections`: the corrected bars of the touched dates replace those
  dates of a bar table.

Every output is a folder per batch id, overwritten when Spark repeats a batch
after a failure, and a batch's watermark depends on earlier batches alone: any
of this can be run again with the same result. Partial aggregates combine in
every task, so a hot symbol is a row a task and period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import nan_to_null
from ..operators.bars import period_start
from .bars_stream import PERIODS, _exists, default_checkpoint

PARTIALS, LATE, PROGRESS = "partials", "late", "progress"
_PROGRESS = T.StructType([
    T.StructField("newest", T.TimestampType()), T.StructField("ticks", T.LongType()),
    T.StructField("late_ticks", T.LongType()), T.StructField("batch", T.LongType())])


def _partial(ticks: DataFrame) -> DataFrame:
    """Partial bars of (date, symbol, tick, price, volume, late)."""
    priced = F.when(F.col("price").isNotNull(), F.struct("tick", "price"))
    return ticks.groupBy("date", "symbol", "late").agg(
        F.min(priced).alias("first"), F.max(priced).alias("last"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("ticks"))


def _merged(partials: DataFrame) -> DataFrame:
    merged = partials.groupBy("date", "symbol").agg(
        F.min("first").alias("first"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max("last").alias("last"), F.sum("volume").cast("bigint").alias("volume"))
    return merged.select("date", "symbol", F.col("first.price").alias("open"), "high", "low",
                         F.col("last.price").alias("close"), "volume")


def _progress(spark: SparkSession, out: str) -> DataFrame:
    path = f"{out.rstrip('/')}/{PROGRESS}"
    if not _exists(spark, path):
        return spark.createDataFrame([], _PROGRESS)
    return spark.read.schema(_PROGRESS).parquet(path)


def start_corrected_bars(ticks: DataFrame, out: str, symbol: str, ts: str, price: str, volume: str, tick_id: str,
                         period: str = "hour", lateness: str = "1 hour", checkpoint: str | None = None,
                         available_now: bool = False) -> StreamingQuery:
    """Start the query that keeps partial bars, late ticks and progress below ``out``."""
    if period not in PERIODS:
        raise ValueError(f"unsupported period {period!r}; use one of {sorted(PERIODS)}")
    spark, root = ticks.sparkSession, out.rstrip("/")

    def keep(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        seen = _progress(session, root).where(F.col("batch") < batch_id)
        mark = seen.agg((F.max("newest") - F.expr(f"INTERVAL {lateness}")).alias("mark"))
        ended = F.col("date").cast("timestamp") + F.expr(f"INTERVAL {PERIODS[period]}")
        # One row: the watermark of the earlier batches.
        rows = (batch.select("*", F.col(ts).cast("timestamp").alias("_at"), period_start(ts, period).alias("date"))
                .crossJoin(F.broadcast(mark)).withColumn("late", F.coalesce(ended <= F.col("mark"), F.lit(False))))
        at = f"batch={batch_id}"
        rows.where("late").select(*batch.columns).write.mode("overwrite").parquet(f"{root}/{LATE}/{at}")
        tick = rows.select("date", F.col(symbol).alias("symbol"), F.col(tick_id).alias("tick"),
                           nan_to_null(F.col(price).cast("double")).alias("price"), F.col(volume).alias("volume"), "late")
        _partial(tick).write.mode("overwrite").parquet(f"{root}/{PARTIALS}/{at}")
        rows.agg(F.max("_at").alias("newest"), F.count(F.lit(1)).alias("ticks"),
                 F.count_if("late").alias("late_ticks")).write.mode("overwrite").parquet(f"{root}/{PROGRESS}/{at}")

    writer = ticks.writeStream.foreachBatch(keep).option(
        "checkpointLocation", checkpoint or default_checkpoint(spark, out))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _partials(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out.rstrip('/')}/{PARTIALS}")


def late_ticks(spark: SparkSession, out: str) -> DataFrame:
    """The ticks that came after the end of their bar, with their batch."""
    return spark.read.parquet(f"{out.rstrip('/')}/{LATE}")


def tick_counts(spark: SparkSession, out: str) -> DataFrame:
    """Per batch the number of ticks and of late ones."""
    return _progress(spark, out).select("batch", "ticks", "late_ticks")


def published_bars(spark: SparkSession, out: str) -> DataFrame:
    """The bars without late ticks."""
    return _merged(_partials(spark, out).where(~F.col("late")))


def corrections(spark: SparkSession, out: str) -> DataFrame:
    """The bars that late ticks touch, from all their ticks."""
    touched = _partials(spark, out).groupBy("date", "symbol").agg(F.max("late").alias("touched"))
    return _merged(_partials(spark, out).join(touched.where("touched"), ["date", "symbol"], "left_semi"))


def corrected_bars(spark: SparkSession, out: str) -> DataFrame:
    """The bars of all ticks, late or not."""
    return _merged(_partials(spark, out))


def merge_corrections(spark: SparkSession, out: str, table: str) -> str:
    """Replace, in a bar table partitioned by ``day``, the days that late ticks touch.

    Only those days are written (dynamic partition overwrite), from the
    partial bars and not from the table, so merging twice changes nothing.
    """
    day = F.to_date("date")
    days = _partials(spark, out).where("late").select(day.alias("day")).distinct()
    bars = corrected_bars(spark, out).withColumn("day", day).join(days, "day", "left_semi")
    (bars.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(table))
    return table
