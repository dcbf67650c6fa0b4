"""Local feature set (L0-L6): the row-at-a-time builder's definitions.

Rows with 0-based index ``i`` (per symbol, in date order) below 5 get no
``sma_5`` / ``return_1d`` / ``volatility_5d`` (NULL); ``volume_normalized``
is set on every row. Volatility is the *population* standard deviation of the
five unrounded one-day returns ending at the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pct_change
from ..functions.windows import DEFAULT_LAYOUT, RN, Layout, finish, rows, segment

# Output names, feature groups and the method label of the
# local builder's metadata.
LOCAL_FEATURES = ["sma_5", "return_1d", "volatility_5d", "volume_normalized"]
TECHNICAL_INDICATORS = ["sma_5"]
PRICE_FEATURES = ["return_1d", "volatility_5d"]
VOLUME_FEATURES = ["volume_normalized"]
LOCAL_METHOD = "local_processing"
FIRST_INDEX = 5       # features start at the 6th bar
VOLUME_UNIT = 1e6     # volume in millions

LOOKBACK = 5  # five returns back need the close six rows back


def local_features(bars: DataFrame, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    s = segment(bars, LOOKBACK, layout, with_rn=True)
    w = layout.window()
    s = s.select("*", pct_change("close", F.lag("close", 1).over(w)).alias("_seg_ret"))
    ready = F.col(RN) >= F.lit(FIRST_INDEX)
    out = s.select(
        "*",
        F.when(ready, F.round(F.avg("close").over(rows(w, 5)), 2)).alias("sma_5"),
        F.when(ready, F.round(F.col("_seg_ret"), 4)).alias("return_1d"),
        F.when(ready, F.round(F.stddev_pop("_seg_ret").over(rows(w, 5)), 4)).alias("volatility_5d"),
        (F.col("volume") / F.lit(VOLUME_UNIT)).alias("volume_normalized"),
    )
    return finish(out)


def local_metadata(bars: DataFrame) -> DataFrame:
    """One row per symbol with the feature groups, record counts and the time of processing.

    Every input bar is kept in the output, so processed = original.
    """
    return (bars.groupBy("symbol")
                .agg(F.count(F.lit(1)).alias("original_records"))
                .select("symbol",
                        F.array(*[F.lit(x) for x in TECHNICAL_INDICATORS]).alias("technical_indicators"),
                        F.array(*[F.lit(x) for x in PRICE_FEATURES]).alias("price_features"),
                        F.array(*[F.lit(x) for x in VOLUME_FEATURES]).alias("volume_features"),
                        F.lit(len(LOCAL_FEATURES)).alias("total_features"),
                        "original_records",
                        F.col("original_records").alias("processed_records"),
                        F.lit(len(LOCAL_FEATURES)).alias("features_added"),
                        F.current_timestamp().alias("processing_timestamp"),
                        F.lit(LOCAL_METHOD).alias("method")))
