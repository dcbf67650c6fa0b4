"""Preprocessing (X1-X5): the steps the preprocessing stage declares.

X5 names the stage's feature set (aliases of advanced/local columns), X1
z-scores a column over a trailing window, X2 drops bars whose z-score is
beyond 3, X3 forward-fills gaps, X4 measures completeness (see
:func:`barsmith.operators.quality.completeness`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ema import EmaPlan
from ..functions.numeric import nan_to_null, safe_div
from ..functions.rolling import Roll, add_rolling, rolling_lookback
from ..functions.windows import DEFAULT_LAYOUT, Layout, finish, segment
from . import advanced as adv

# The stage's declared configuration and feature names.
WINDOW_SIZE = 20
OUTLIER_STD = 3.0
COMPLETENESS_THRESHOLD = 0.8
PREP_FEATURES = ["sma_20", "rsi_14", "macd", "returns", "volatility", "volume_sma", "volume_ratio"]
PREP_SOURCES = {"sma_20": "SMA_20", "rsi_14": "RSI_14", "macd": "MACD_12_26",
                "volatility": "Volatility_20", "volume_sma": "Volume_SMA_20",
                "volume_ratio": "Volume_Ratio_20"}


def prep_features(bars: DataFrame, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """The stage's seven features per bar.

    ``returns`` is the unrounded one-day return (close - prev) / prev; the
    others alias advanced columns (window size 20 where one is needed), which
    are the only ones computed.
    """
    feats = adv.advanced_features(bars, layout, with_prev_close=True, columns=list(PREP_SOURCES.values()))
    prev = F.col("prev_close")
    return feats.select("symbol", "date", "close",
                        *[F.col(PREP_SOURCES[c]).alias(c) if c in PREP_SOURCES
                          else safe_div(F.col("close") - prev, prev).alias(c)
                          for c in PREP_FEATURES])


def zscore(df: DataFrame, column: str, window: int = WINDOW_SIZE, out: str | None = None,
           layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """(x - mean) / sample stddev over the trailing ``window`` rows (full windows only)."""
    out = out or f"{column}_z"
    rolls = [Roll("_seg_mean", "avg", "_seg_x", window), Roll("_seg_dev", "stddev", "_seg_x", window)]
    s = segment(df, rolling_lookback(rolls), layout, with_rn=True)
    # A NaN would stay in the running sums; it is a missing value.
    x = F.col(column)
    s = s.withColumn("_seg_x", nan_to_null(column) if dict(df.dtypes)[column] in ("double", "float") else x)
    s = add_rolling(s, rolls, EmaPlan(layout.key, ()))
    return finish(s.select("*", safe_div(x - F.col("_seg_mean"), F.col("_seg_dev")).alias(out)))


def remove_outliers(df: DataFrame, column: str, window: int = WINDOW_SIZE,
                    limit: float = OUTLIER_STD, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Drop bars whose z-score of ``column`` is beyond ``limit``.

    Bars without a z-score (too little history, zero spread) are kept: they
    are not known to be outliers.
    """
    zc = f"_{column}_z"
    z = zscore(df, column, window, zc, layout)
    return z.filter(F.col(zc).isNull() | (F.abs(F.col(zc)) <= F.lit(limit))).drop(zc)


def forward_fill(df: DataFrame, columns: list[str], layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Replace NULL/NaN by the last earlier value of the same symbol.

    Exact across chunk boundaries however long a gap is: the pass that counts
    the bars of a symbol's time buckets also takes each bucket's last value;
    carried over the buckets before a chunk, it arrives with the chunk's bounds.
    One window pass then fills within the chunk.
    """
    types = dict(df.dtypes)
    clean = {c: F.when(~F.isnan(c), F.col(c)) if types[c] in ("double", "float") else F.col(c) for c in columns}
    s = segment(df.withColumns(clean), 0, layout, with_rn=False, carry=tuple(columns))
    w = layout.window().rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_seg_carry_{c}")) for c in columns}
    return finish(s.withColumns(filled)).select(*df.columns)
