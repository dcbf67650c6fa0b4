"""Tables written once and read several times, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and return a reader of it.

    For what a job reads more than once: the plan behind ``df`` runs once, and a
    lost executor costs a reread of the written table.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, 'written')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bar_table(bars: DataFrame) -> DataFrame:
    """The bars as a written table: what the feature sets count and read stays off the raw input."""
    return written(bars, "bars")
