"""Daily feature set (D1-D7) and the run columns around it.

Spark semantics of the original job: partial windows from the first row,
sample standard deviation of *close*, percentage change x100.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_div
from ..functions.windows import DEFAULT_LAYOUT, Layout, finish, partial, segment

# Output names of the daily set and the prefixes that count as
# features, and the processing-method label of the metadata struct.
DAILY_FEATURES = ["sma_5", "sma_20", "price_change", "price_change_pct",
                  "volatility_5d", "volume_sma_5", "high_low_ratio"]
FEATURE_PREFIXES = ("sma_", "price_", "volatility_", "volume_", "high_low")
DAILY_METHOD = "glue_pyspark"
PREVIEW_COLUMNS = ["date", "symbol", "close", "sma_5", "sma_20", "price_change", "volatility_5d"]

LOOKBACK = 19  # sma_20 reads the 19 preceding rows


def daily_features(bars: DataFrame, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """bars -> bars + D1-D7, per symbol in date order."""
    s = segment(bars, LOOKBACK, layout, with_rn=False)
    w = layout.window()
    s = s.select("*", F.lag("close", 1).over(w).alias("_seg_prev"))
    prev = F.col("_seg_prev")
    out = s.select(
        "*",
        partial(F.avg, "close", 5, w).alias("sma_5"),
        partial(F.avg, "close", 20, w).alias("sma_20"),
        (F.col("close") - prev).alias("price_change"),
        (safe_div(F.col("close") - prev, prev) * F.lit(100)).alias("price_change_pct"),
        partial(F.stddev_samp, "close", 5, w).alias("volatility_5d"),
        partial(F.avg, "volume", 5, w).alias("volume_sma_5"),
        safe_div("high", "low").alias("high_low_ratio"),
    )
    return finish(out)


def feature_names(df: DataFrame, prefixes=FEATURE_PREFIXES) -> list[str]:
    """Feature columns by name prefix (7 for plain bars)."""
    return [c for c in df.columns if c.startswith(tuple(prefixes))]


def with_run_columns(df: DataFrame, symbol_label: str | None = None,
                     method: str = DAILY_METHOD) -> DataFrame:
    """Run timestamp, processed-symbol label and metadata struct.

    The feature count is taken from the schema (a driver-side list of column
    names, not data). Without a label the row's own symbol is used.
    """
    count = len(feature_names(df))
    label = F.lit(symbol_label) if symbol_label is not None else F.col("symbol")
    return df.select(
        "*",
        F.current_timestamp().alias("processing_timestamp"),
        label.alias("symbol_processed"),
        F.struct(F.lit(count).alias("feature_count"),
                 F.lit(method).alias("processing_method"),
                 F.current_timestamp().alias("created_at")).alias("feature_engineering_metadata"),
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """P5: the first ``n`` rows of the preview projection, in (symbol, date) order."""
    return df.select(*PREVIEW_COLUMNS).orderBy("symbol", "date").limit(n)
