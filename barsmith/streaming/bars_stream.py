"""Structured Streaming form of bar building (B1) and its incremental sink.

Ticks arrive as files (or any streaming source); bars are aggregated per
(symbol, period window) with a watermark, so a bar is emitted once the
watermark passes the end of its period and its state is dropped. Every
aggregate is combinable (min_by / max / min / max_by / sum), so state per
open bar is constant-size whatever the tick rate of a hot symbol.

Downstream, the emitted bars are appended to a bar table; the batch feature
jobs read that table (their windows need ordered history, which is a batch
concern).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.numeric import nan_to_null
from ..session import shared_root

# Spark interval strings per supported bar period.
PERIODS = {"minute": "1 minute", "hour": "1 hour", "day": "1 day"}


def stream_bars(ticks: DataFrame, symbol: str, ts: str, price: str, volume: str,
                tick_id: str, period: str = "hour", lateness: str = "1 hour") -> DataFrame:
    """Streaming ticks -> bars ``(date, symbol, open, high, low, close, volume)``.

    ``lateness`` is the watermark delay: ticks later than that behind the
    newest event time are dropped by Spark, and bars are final (append mode).
    A NaN price counts as missing, as in the batch form.

    Event-time windows are aligned to UTC, calendar days to the session zone,
    so daily bars are refused in any other session zone rather than dated
    differently from the batch form.
    """
    if period not in PERIODS:
        raise ValueError(f"unsupported period {period!r}; use one of {sorted(PERIODS)}")
    zone = ticks.sparkSession.conf.get("spark.sql.session.timeZone")
    if period == "day" and zone.upper() not in ("UTC", "ETC/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"daily bars need spark.sql.session.timeZone=UTC, not {zone}")
    p, t = nan_to_null(F.col(price).cast("double")), F.col(tick_id)
    known = F.when(p.isNotNull(), t)
    ticks = ticks.withColumn("_ts", F.col(ts).cast("timestamp"))
    bars = (ticks.withWatermark("_ts", lateness)
                 .groupBy(F.window("_ts", PERIODS[period]).alias("w"), F.col(symbol).alias("symbol"))
                 .agg(F.min_by(p, known).alias("open"), F.max(p).alias("high"), F.min(p).alias("low"),
                      F.max_by(p, known).alias("close"), F.sum(F.col(volume)).cast("bigint").alias("volume")))
    date = F.to_date(F.col("w.start")) if period == "day" else F.col("w.start")
    return bars.select(date.alias("date"), "symbol", "open", "high", "low", "close", "volume")


def tick_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """File source of ticks (new files under ``path`` become new input)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_name(out: str) -> str:
    """Stable name of the sink writing to ``out`` (same in every process)."""
    return hashlib.sha256(out.rstrip("/").encode("utf-8")).hexdigest()[:24]


def default_checkpoint(spark: SparkSession, out: str) -> str:
    """Checkpoint folder of the sink writing to ``out``.

    Below the folder *named* by ``spark.checkpoint.dir``, which is the same for
    every driver. (``SparkContext.getCheckpointDir`` adds an id per context: a
    restarted driver would not find the checkpoint.)
    """
    return f"{shared_root(spark).rstrip('/')}/streams/{stream_name(out)}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def start_bar_sink(bars: DataFrame, out: str, checkpoint: str | None = None,
                   available_now: bool = False) -> StreamingQuery:
    """Append finished bars to a Parquet bar table (exactly-once via the checkpoint).

    The checkpoint defaults to a folder below the shared folder the cluster
    names, so a restarted or re-scheduled query, in whichever driver, resumes.

    The sink's log numbers batches by the checkpoint: an output that already
    has a log, written under a checkpoint that is not there any more, would
    skip the first new batches as already done. That is refused.
    """
    spark = bars.sparkSession
    ckpt = checkpoint or default_checkpoint(spark, out)
    if _exists(spark, f"{out.rstrip('/')}/_spark_metadata") and not _exists(spark, f"{ckpt.rstrip('/')}/offsets"):
        raise RuntimeError(f"{out} was written under another checkpoint than {ckpt}: name that one, "
                           "or write to a new folder")
    writer = (bars.writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
