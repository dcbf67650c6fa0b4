"""Advanced feature set (A1-A28): 82 indicator columns per bar.

pandas-rolling semantics (``full``): a rolling value exists only once the
frame holds ``n`` non-null inputs. EMAs follow ``ewm(span=n).mean()`` with
``adjust=True`` (see :mod:`barsmith.functions.ema`). All windows of the set
share one partitioning (symbol, chunk) and one ordering, so the plan has a
single exchange of the bars.

Column names use ``_`` where the original names carry a decimal point
(``BB_Upper_20_2_5`` for ``BB_Upper_20_2.5``); :data:`REFERENCE_NAMES` maps
back for output documents that need the dotted names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ema import EmaPlan, drop_ema_helpers, ema_finish, ema_locals, halo_rows
from ..functions.numeric import nan_to_null
from ..functions.rolling import (Roll, drop_rolling_helpers, rolling_final, rolling_lookback, rolling_pass0,
                                 rolling_pass1, rolling_pass2, rolling_plan)
from ..functions.windows import CHUNK, DEFAULT_LAYOUT, HALO, TB, Layout, finish, segment
from ..schema import PRICE_FIELDS

# Indicator parameters of the advanced set.
SMA_PERIODS = [5, 10, 20, 50, 100, 200]
RSI_PERIODS = [7, 14, 21, 30]
MACD_SETS = [(12, 26, 9), (8, 21, 5), (5, 13, 8)]
BB_SETS = [(20, 2), (20, 2.5), (10, 1.5)]
VOLATILITY_PERIODS = [5, 10, 20, 30]
VOLUME_PERIODS = [5, 10, 20]
MOMENTUM_PERIODS = [5, 10, 20]
SR_PERIODS = [20, 50]
TREND_PERIODS = [10, 20, 50]
BASE_COLUMNS = ["open", "high", "low", "close", "volume"]


def _num(k) -> str:
    return str(k).replace(".", "_")


def bb(kind: str, n: int, k) -> str:
    return f"BB_{kind}_{n}_{_num(k)}"


FAMILIES: dict[str, list[str]] = {
    "sma": [f"SMA_{n}" for n in SMA_PERIODS],
    "ema": [f"EMA_{n}" for n in SMA_PERIODS],
    "rsi": [f"RSI_{n}" for n in RSI_PERIODS],
    "macd": [c for f, s, g in MACD_SETS
             for c in (f"MACD_{f}_{s}", f"MACD_Signal_{f}_{s}_{g}", f"MACD_Hist_{f}_{s}_{g}")],
    "bbands": [bb(kind, n, k) for n, k in BB_SETS for kind in ("Upper", "Lower", "Width", "Position")],
    "price": ["Price_Range", "Price_Position", "Gap", "Gap_Percent"],
    "volatility": [c for n in VOLATILITY_PERIODS for c in (f"Volatility_{n}", f"ATR_{n}")],
    "volume": [c for n in VOLUME_PERIODS
               for c in (f"Volume_SMA_{n}", f"Volume_Ratio_{n}", f"Price_Volume_{n}", f"VWAP_{n}")],
    "momentum": [c for n in MOMENTUM_PERIODS for c in (f"Momentum_{n}", f"ROC_{n}")],
    "support_resistance": [c for n in SR_PERIODS
                           for c in (f"Resistance_{n}", f"Support_{n}", f"Support_Resistance_Ratio_{n}")],
    "trend": [c for n in TREND_PERIODS for c in (f"Trend_{n}", f"Upper_Shadow_{n}", f"Lower_Shadow_{n}")],
}

# Column order of the original builder (its loops interleave SMA and EMA).
ADVANCED_FEATURES: list[str] = (
    [c for n in SMA_PERIODS for c in (f"SMA_{n}", f"EMA_{n}")]
    + FAMILIES["rsi"] + FAMILIES["macd"] + FAMILIES["bbands"] + FAMILIES["price"]
    + FAMILIES["volatility"] + FAMILIES["volume"] + FAMILIES["momentum"]
    + FAMILIES["support_resistance"] + FAMILIES["trend"])
assert len(ADVANCED_FEATURES) == 82

REFERENCE_NAMES = {bb(kind, n, k): f"BB_{kind}_{n}_{k}"
                   for n, k in BB_SETS for kind in ("Upper", "Lower", "Width", "Position")}
FEATURES_COUNT = len(BASE_COLUMNS) + len(ADVANCED_FEATURES)  # every column but the date

EMA_SPANS = sorted(set(SMA_PERIODS) | {x for f, s, _ in MACD_SETS for x in (f, s)})


def rolling_specs() -> list[Roll]:
    """Every trailing-window aggregate of the set (pandas rolling semantics)."""
    r = [Roll(f"SMA_{n}", "avg", "close", n) for n in SMA_PERIODS]
    r += [Roll(f"_a_sd{n}", "stddev", "close", n) for n in sorted({n for n, _ in BB_SETS})]
    r += [Roll(f"ATR_{n}", "avg", "_a_hl", n) for n in VOLATILITY_PERIODS]
    r += [Roll(f"Volume_SMA_{n}", "avg", "volume", n) for n in VOLUME_PERIODS]
    r += [Roll(f"_a_pv{n}", "sum", "_a_pv", n) for n in VOLUME_PERIODS]
    r += [Roll(f"_a_v{n}", "sum", "volume", n) for n in VOLUME_PERIODS]
    r += [Roll(f"Resistance_{n}", "max", "high", n) for n in SR_PERIODS]
    r += [Roll(f"Support_{n}", "min", "low", n) for n in SR_PERIODS]
    r += [Roll(f"_a_g{n}", "avg", "_a_gain", n) for n in RSI_PERIODS]
    r += [Roll(f"_a_l{n}", "avg", "_a_loss", n) for n in RSI_PERIODS]
    r += [Roll(f"Volatility_{n}", "stddev", "_a_ret", n) for n in VOLATILITY_PERIODS]
    return r


def _rsi(g: str, l: str) -> str:
    """100 - 100/(1 + g/l); l = 0 gives 100 when g > 0 and NULL when g = 0."""
    return (f"CASE WHEN {g} IS NULL OR {l} IS NULL THEN NULL "
            f"WHEN {l} = 0 THEN (CASE WHEN {g} > 0 THEN 100D END) "
            f"ELSE 100D - 100D / (1D + {g} / {l}) END")


def _div(a: str, b: str) -> str:
    return f"try_divide({a}, {b})"


def derived_columns() -> dict[str, str]:
    """The 82 outputs as SQL over the window results (no window of their own)."""
    d: dict[str, str] = {}
    for n in SMA_PERIODS:
        d[f"SMA_{n}"] = f"SMA_{n}"
        d[f"EMA_{n}"] = f"_a_ema{n}"
    for n in RSI_PERIODS:
        d[f"RSI_{n}"] = _rsi(f"_a_g{n}", f"_a_l{n}")
    for f, sl, g in MACD_SETS:
        d[f"MACD_{f}_{sl}"] = f"MACD_{f}_{sl}"
        d[f"MACD_Signal_{f}_{sl}_{g}"] = f"MACD_Signal_{f}_{sl}_{g}"
        d[f"MACD_Hist_{f}_{sl}_{g}"] = f"MACD_{f}_{sl} - MACD_Signal_{f}_{sl}_{g}"
    for n, k in BB_SETS:
        upper = f"(SMA_{n} + _a_sd{n} * {float(k)!r}D)"
        lower = f"(SMA_{n} - _a_sd{n} * {float(k)!r}D)"
        d[bb("Upper", n, k)] = upper
        d[bb("Lower", n, k)] = lower
        d[bb("Width", n, k)] = _div(f"{upper} - {lower}", f"SMA_{n}")
        d[bb("Position", n, k)] = _div(f"close - {lower}", f"{upper} - {lower}")
    d["Price_Range"] = "high - low"
    d["Price_Position"] = _div("close - low", "high - low")
    d["Gap"] = "open - _a_prev"
    d["Gap_Percent"] = _div("open - _a_prev", "_a_prev")
    for n in VOLATILITY_PERIODS:
        d[f"Volatility_{n}"] = f"Volatility_{n}"
        d[f"ATR_{n}"] = f"ATR_{n}"
    for n in VOLUME_PERIODS:
        d[f"Volume_SMA_{n}"] = f"Volume_SMA_{n}"
        d[f"Volume_Ratio_{n}"] = _div("volume", f"Volume_SMA_{n}")
        d[f"Price_Volume_{n}"] = "close * volume"
        d[f"VWAP_{n}"] = _div(f"_a_pv{n}", f"_a_v{n}")
    for n in MOMENTUM_PERIODS:
        d[f"Momentum_{n}"] = _div("close", f"_a_lag{n}")
        d[f"ROC_{n}"] = _div(f"close - _a_lag{n}", f"_a_lag{n}") + " * 100D"
    for n in SR_PERIODS:
        d[f"Resistance_{n}"] = f"Resistance_{n}"
        d[f"Support_{n}"] = f"Support_{n}"
        d[f"Support_Resistance_Ratio_{n}"] = _div(f"close - Support_{n}", f"Resistance_{n} - Support_{n}")
    for n in TREND_PERIODS:
        d[f"Trend_{n}"] = _div("close", f"SMA_{n}")
        d[f"Upper_Shadow_{n}"] = _div("high - greatest(open, close)", "close")
        d[f"Lower_Shadow_{n}"] = _div("least(open, close) - low", "close")
    return d


@dataclass(frozen=True)
class Needs:
    """What a set of output columns is computed from, found by following the expressions."""

    rolls: tuple[Roll, ...]
    emas: tuple[int, ...]                      # spans over the close
    macds: tuple[tuple[int, int, int], ...]    # difference lines
    signals: tuple[tuple[int, int, int], ...]  # of these, the ones with a signal line
    lags: tuple[int, ...]

    @property
    def lookback(self) -> int:
        """Rows of history a chunk needs so every value of its first row is exact."""
        ema = halo_rows(list(self.emas))
        chain = max([halo_rows([f, s]) + halo_rows([g]) for f, s, g in self.signals], default=0)
        # One more row: returns, gains and losses look at the row before.
        return max(ema, chain, rolling_lookback(list(self.rolls)), *self.lags, 0) + 1

    @property
    def spans(self) -> list[int]:
        return [*self.emas, *[g for _, _, g in self.signals]]


def needs_of(columns: list[str]) -> Needs:
    """The window results that ``columns`` (names of the set) are derived from."""
    derived = derived_columns()
    unknown = [c for c in columns if c not in derived]
    if unknown:
        raise ValueError(f"no columns of the advanced set: {unknown}")
    used = {w for c in columns for w in re.findall(r"\w+", derived[c])}
    macds = tuple(m for m in MACD_SETS if f"MACD_{m[0]}_{m[1]}" in used or f"MACD_Signal_{m[0]}_{m[1]}_{m[2]}" in used)
    signals = tuple(m for m in macds if f"MACD_Signal_{m[0]}_{m[1]}_{m[2]}" in used)
    spans = {n for n in EMA_SPANS if f"_a_ema{n}" in used} | {x for f, s, _ in macds for x in (f, s)}
    return Needs(tuple(r for r in rolling_specs() if r.out in used), tuple(sorted(spans)), macds, signals,
                 tuple(n for n in MOMENTUM_PERIODS if f"_a_lag{n}" in used))


def lookback_rows(columns: list[str] | None = None) -> int:
    """Rows of history a chunk needs for ``columns`` (default: all)."""
    return needs_of(ADVANCED_FEATURES if columns is None else columns).lookback


#: Per-bar inputs of the rolling aggregates, as SQL.
_INPUTS = {
    "_a_hl": "high - low",
    "_a_pv": "close * volume",
    "_a_gain": "CASE WHEN close - _a_prev > 0 THEN close - _a_prev ELSE 0D END",
    "_a_loss": "CASE WHEN -(close - _a_prev) > 0 THEN -(close - _a_prev) ELSE 0D END",
    "_a_ret": "try_divide(close, _a_prev) - 1D",
}


def advanced_features(bars: DataFrame, layout: Layout = DEFAULT_LAYOUT, with_prev_close: bool = False,
                      columns: list[str] | None = None) -> DataFrame:
    """bars -> bars + the 82 advanced columns (rows with gaps kept; see :func:`complete_rows`).

    ``columns`` names the ones wanted: window passes, block sizes and the look-back (the halo
    rows of a chunk) are those that they need. ``with_prev_close`` also returns the previous bar's
    close (``prev_close``) for callers that derive more per-bar values without another window pass.
    Expressions are generated as SQL text (one ``selectExpr`` per pass), which
    keeps the driver-side plan construction cheap for ~300 expressions.
    """
    columns = ADVANCED_FEATURES if columns is None else list(columns)
    need = needs_of(columns)
    # A NaN would stay in the block-local running sums; it is a missing value.
    bars = bars.withColumns({c: nan_to_null(c) for c, t in bars.dtypes if t == "double" and c in PRICE_FIELDS})
    s = segment(bars, need.lookback, layout, with_rn=True)
    rolls = list(need.rolls)
    plan = rolling_plan(EmaPlan.for_spans(layout.key, need.spans), rolls)
    # Each Window operator copies the row, so passes are few: lags share the
    # row-number window (date order); then suffixes of blocks in reverse order; then block-local sums
    # and prefixes; then carries / lags / short frames; then the MACD signals.
    wd = f"OVER (PARTITION BY `{layout.key}`, {CHUNK} ORDER BY {TB}, `{layout.order}`)"
    s = s.selectExpr("*", f"lag(close, 1) {wd} AS _a_prev",
                     *[f"lag(close, {n}) {wd} AS _a_lag{n}" for n in need.lags])
    sources = {r.src for r in rolls}
    s = s.selectExpr("*", *[f"{sql} AS {name}" for name, sql in _INPUTS.items() if name in sources])
    s = plan.add_blocks(s)
    close_emas = [("close", n, f"_a_ema{n}") for n in need.emas]
    if any(r.edges for r in rolls):
        s = s.selectExpr("*", *rolling_pass0(rolls, plan))
    s = s.selectExpr("*", *rolling_pass1(rolls, plan), *ema_locals(close_emas, plan))
    s = s.selectExpr("*", *rolling_pass2(rolls, plan), *ema_finish(close_emas, plan))
    s = s.selectExpr("*", *rolling_final(rolls, plan),
                     *[f"_a_ema{f} - _a_ema{sl} AS MACD_{f}_{sl}" for f, sl, _ in need.macds])
    s = drop_rolling_helpers(drop_ema_helpers(s))
    if need.signals:
        signals = [(f"MACD_{f}_{sl}", g, f"MACD_Signal_{f}_{sl}_{g}") for f, sl, g in need.signals]
        s = s.selectExpr("*", *ema_locals(signals, plan))
        s = drop_ema_helpers(s.selectExpr("*", *ema_finish(signals, plan)))

    derived = derived_columns()
    keep = [f"`{c}`" for c in bars.columns] + [HALO]
    if with_prev_close:
        keep.append("_a_prev AS prev_close")
    out = s.selectExpr(*keep, *[f"{derived[c]} AS `{c}`" for c in columns])
    return finish(out)


def select_family(df: DataFrame, family: str, keys=("symbol", "date")) -> DataFrame:
    return df.select(*keys, *FAMILIES[family])


def complete_predicate(columns: list[str]) -> Column:
    """True when no column is NULL or NaN (``dropna(how="any")``)."""
    return F.expr(" AND ".join(f"(`{c}` IS NOT NULL AND NOT isnan(`{c}`))" for c in columns))


def complete_rows(features: DataFrame) -> DataFrame:
    """Keep rows with a value in every column (NULL and NaN both count as gaps)."""
    return features.na.drop(how="any")


def advanced_metadata(features: DataFrame, processing_type: str = "advanced_features") -> DataFrame:
    """K7 metadata: per symbol, original and complete row counts and the feature list.

    One aggregation over the feature table (no join): the complete-row test
    is a predicate counted with ``count_if``.
    """
    cols = [c for c in features.columns if c not in ("symbol", "date")]
    names = [REFERENCE_NAMES.get(c, c) for c in cols]
    pred = complete_predicate(cols) & F.col("date").isNotNull()
    return (features.groupBy("symbol")
                    .agg(F.count(F.lit(1)).alias("Original_Records"),
                         F.count_if(pred).alias("Records_Count"))
                    .select(F.col("symbol").alias("Symbol"),
                            F.lit(processing_type).alias("Processing_Type"),
                            F.array(*[F.lit(n) for n in names]).alias("Features_Created"),
                            "Records_Count", "Original_Records",
                            F.lit(len(cols)).alias("Features_Count")))
