"""DuckDB SQL that recomputes each registered query from the driver tables.

Written independently of the Spark code from the feature definitions; used
by the correctness gate at sf0.01. Divisions use ``CASE WHEN d = 0`` so that
x/0 gives NULL like ``try_divide`` (DuckDB would return inf/NaN).
"""

from __future__ import annotations

BARS_ORDERS = """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol,
       arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
       CAST(sum(floor(o_totalprice)) AS BIGINT) AS volume
FROM orders GROUP BY 1, 2
"""

BARS_EVENTS = """
SELECT date_trunc('hour', ts) AS date, event_type AS symbol,
       arg_min(value, event_id) AS open, max(value) AS high,
       min(value) AS low, arg_max(value, event_id) AS close,
       CAST(count(*) AS BIGINT) AS volume
FROM events GROUP BY 1, 2
"""


def rnd(expr: str, digits: int) -> str:
    """round() as Spark does it: Spark never returns -0.0 from round, DuckDB can."""
    return f"(round({expr}, {digits}) + 0.0)"


def with_bars(body: str, bars: str = BARS_ORDERS) -> str:
    return f"WITH bars AS ({bars})\n{body}"


def div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


W = "PARTITION BY symbol ORDER BY date"


def frame(n: int) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(agg: str, expr: str, n: int) -> str:
    """pandas rolling(n): NULL until n non-null values."""
    return (f"(CASE WHEN count({expr}) OVER {frame(n)} = {n} "
            f"THEN {agg}({expr}) OVER {frame(n)} END)")


DAILY = """
SELECT date, symbol, open, high, low, close, volume,
       {r_sma5} AS sma_5,
       {r_sma20} AS sma_20,
       close - lag(close) OVER w AS price_change,
       {pct} AS price_change_pct,
       {r_vol5} AS volatility_5d,
       {r_vsma5} AS volume_sma_5,
       {hl} AS high_low_ratio
FROM bars
WINDOW w AS (PARTITION BY symbol ORDER BY date),
       w5 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
       w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
""".format(pct=div("close - lag(close) OVER w", "lag(close) OVER w") + " * 100",
           hl=div("high", "low"), r_sma5=rnd("avg(close) OVER w5", 6),
           r_sma20=rnd("avg(close) OVER w20", 6), r_vol5=rnd("stddev_samp(close) OVER w5", 4),
           r_vsma5=rnd("avg(volume) OVER w5", 6))


# ---------------------------------------------------------------------------
# Advanced set. One generated query: EMAs by a recursive CTE (the plain
# recurrence num_t = x_t + q num_{t-1}, den_t = 1 + q den_{t-1}), everything
# else by window functions over PARTITION BY symbol ORDER BY date.

SMA_P = [5, 10, 20, 50, 100, 200]
RSI_P = [7, 14, 21, 30]
MACD_S = [(12, 26, 9), (8, 21, 5), (5, 13, 8)]
BB_S = [(20, 2), (20, 2.5), (10, 1.5)]
VOLA_P = [5, 10, 20, 30]
VOLU_P = [5, 10, 20]
MOM_P = [5, 10, 20]
SR_P = [20, 50]
TREND_P = [10, 20, 50]


def _q(span: int) -> str:
    return repr(1.0 - 2.0 / (span + 1.0))


def _bbn(kind, n, k):
    return f"BB_{kind}_{n}_{str(k).replace('.', '_')}"


def _ema_cte() -> str:
    spans = sorted(set(SMA_P) | {x for f, s, _ in MACD_S for x in (f, s)})
    sig = [(f, s, g) for f, s, g in MACD_S]
    cols = ["symbol", "rn"] + [f"n{s}" for s in spans] + [f"d{s}" for s in spans] \
        + [f"sn{f}_{s}" for f, s, _ in sig] + [f"sd{f}_{s}" for f, s, _ in sig]

    def ema_new(s):  # EMA at the new row, from the previous state
        return f"((b.close + {_q(s)} * e.n{s}) / (1.0 + {_q(s)} * e.d{s}))"

    seed = (["symbol", "rn"] + ["CAST(close AS DOUBLE)" for _ in spans]
            + ["CAST(1.0 AS DOUBLE)" for _ in spans]
            + ["CAST(0.0 AS DOUBLE)" for _ in sig]  # MACD is 0 on the first row
            + ["CAST(1.0 AS DOUBLE)" for _ in sig])
    step = (["b.symbol", "b.rn"] + [f"b.close + {_q(s)} * e.n{s}" for s in spans]
            + [f"1.0 + {_q(s)} * e.d{s}" for s in spans]
            + [f"({ema_new(f)} - {ema_new(s)}) + {_q(g)} * e.sn{f}_{s}" for f, s, g in sig]
            + [f"1.0 + {_q(g)} * e.sd{f}_{s}" for f, s, g in sig])
    return (f"e({', '.join(cols)}) AS (\n  SELECT {', '.join(seed)} FROM b WHERE rn = 0\n"
            f"  UNION ALL\n  SELECT {', '.join(step)}\n"
            f"  FROM e JOIN b ON b.symbol = e.symbol AND b.rn = e.rn + 1)")


def advanced_sql(columns: list[str], digits: dict[str, int], bars: str = BARS_ORDERS,
                 where: str | None = None, aliases: dict[str, str] | None = None,
                 keys: tuple[str, ...] = ("symbol", "date")) -> str:
    """SELECT symbol, date, <columns> with the given rounding (``aliases``: out -> source)."""
    aliases = aliases or {}
    w = "OVER (PARTITION BY symbol ORDER BY date)"
    f1 = ["symbol", "date", "rn", "open", "high", "low", "close", "volume",
          f"lag(close) {w} AS prev"]
    f1 += [f"lag(close, {n}) {w} AS lag{n}" for n in MOM_P]
    f1 += [f"{full('avg', 'close', n)} AS SMA_{n}" for n in SMA_P]
    f1 += [f"{full('stddev_samp', 'close', n)} AS sd{n}" for n in sorted({n for n, _ in BB_S})]
    f1 += [f"{full('avg', 'high - low', n)} AS ATR_{n}" for n in VOLA_P]
    f1 += [f"{full('avg', 'volume', n)} AS Volume_SMA_{n}" for n in VOLU_P]
    f1 += [f"{full('sum', 'close * volume', n)} AS pv{n}" for n in VOLU_P]
    f1 += [f"{full('sum', 'volume', n)} AS v{n}" for n in VOLU_P]
    f1 += [f"{full('max', 'high', n)} AS Resistance_{n}" for n in SR_P]
    f1 += [f"{full('min', 'low', n)} AS Support_{n}" for n in SR_P]
    f2 = ["*", "CASE WHEN close - prev > 0 THEN close - prev ELSE 0 END AS gain",
          "CASE WHEN prev - close > 0 THEN prev - close ELSE 0 END AS loss",
          f"{div('close', 'prev')} - 1.0 AS ret"]
    f3 = ["*"] + [f"{full('avg', 'gain', n)} AS g{n}" for n in RSI_P] \
        + [f"{full('avg', 'loss', n)} AS l{n}" for n in RSI_P] \
        + [f"{full('stddev_samp', 'ret', n)} AS Volatility_{n}" for n in VOLA_P]

    def ema(s):
        return f"(e.n{s} / e.d{s})"

    d: dict[str, str] = {}
    for n in SMA_P:
        d[f"SMA_{n}"] = f"SMA_{n}"
        d[f"EMA_{n}"] = ema(n)
    for n in RSI_P:
        d[f"RSI_{n}"] = (f"(CASE WHEN g{n} IS NULL OR l{n} IS NULL THEN NULL "
                         f"WHEN l{n} = 0 THEN (CASE WHEN g{n} > 0 THEN 100.0 END) "
                         f"ELSE 100.0 - 100.0 / (1.0 + g{n} / l{n}) END)")
    for f, s, g in MACD_S:
        d[f"MACD_{f}_{s}"] = f"({ema(f)} - {ema(s)})"
        d[f"MACD_Signal_{f}_{s}_{g}"] = f"(e.sn{f}_{s} / e.sd{f}_{s})"
        d[f"MACD_Hist_{f}_{s}_{g}"] = f"(({ema(f)} - {ema(s)}) - (e.sn{f}_{s} / e.sd{f}_{s}))"
    for n, k in BB_S:
        up, lo = f"(SMA_{n} + sd{n} * {float(k)!r})", f"(SMA_{n} - sd{n} * {float(k)!r})"
        d[_bbn("Upper", n, k)] = up
        d[_bbn("Lower", n, k)] = lo
        d[_bbn("Width", n, k)] = div(f"{up} - {lo}", f"SMA_{n}")
        d[_bbn("Position", n, k)] = div(f"close - {lo}", f"{up} - {lo}")
    d["returns"] = div("close - prev", "prev")
    d["Price_Range"] = "(high - low)"
    d["Price_Position"] = div("close - low", "high - low")
    d["Gap"] = "(open - prev)"
    d["Gap_Percent"] = div("open - prev", "prev")
    for n in VOLA_P:
        d[f"Volatility_{n}"] = f"Volatility_{n}"
        d[f"ATR_{n}"] = f"ATR_{n}"
    for n in VOLU_P:
        d[f"Volume_SMA_{n}"] = f"Volume_SMA_{n}"
        d[f"Volume_Ratio_{n}"] = div("volume", f"Volume_SMA_{n}")
        d[f"Price_Volume_{n}"] = "(close * volume)"
        d[f"VWAP_{n}"] = div(f"pv{n}", f"v{n}")
    for n in MOM_P:
        d[f"Momentum_{n}"] = div("close", f"lag{n}")
        d[f"ROC_{n}"] = div(f"close - lag{n}", f"lag{n}") + " * 100.0"
    for n in SR_P:
        d[f"Support_Resistance_Ratio_{n}"] = div(f"close - Support_{n}", f"Resistance_{n} - Support_{n}")
        d[f"Resistance_{n}"] = f"Resistance_{n}"
        d[f"Support_{n}"] = f"Support_{n}"
    for n in TREND_P:
        d[f"Trend_{n}"] = div("close", f"SMA_{n}")
        d[f"Upper_Shadow_{n}"] = div("high - greatest(open, close)", "close")
        d[f"Lower_Shadow_{n}"] = div("least(open, close) - low", "close")

    all_cols = ",\n       ".join(f"{d[c]} AS {c}" for c in d)
    return (f"WITH RECURSIVE bars AS ({bars}),\n"
            f"b AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS rn FROM bars),\n"
            f"{_ema_cte()},\n"
            f"f1 AS (SELECT {', '.join(f1)} FROM b),\n"
            f"f2 AS (SELECT {', '.join(f2)} FROM f1),\n"
            f"f3 AS (SELECT {', '.join(f3)} FROM f2),\n"
            f"adv AS (SELECT f3.symbol, f3.date, f3.rn, f3.open, f3.high, f3.low, f3.close, f3.volume,\n"
            f"       {all_cols}\n"
            f"  FROM f3 JOIN e ON e.symbol = f3.symbol AND e.rn = f3.rn)\n"
            f"SELECT {', '.join(list(keys) + [(f'{rnd(aliases.get(c, c), digits[c])} AS {c}' if c in digits else f'{aliases.get(c, c)} AS {c}') for c in columns])}\n"
            f"FROM adv" + (f"\nWHERE {where}" if where else ""))


ADVANCED_NAMES = (
    [c for n in SMA_P for c in (f"SMA_{n}", f"EMA_{n}")]
    + [f"RSI_{n}" for n in RSI_P]
    + [c for f, s, g in MACD_S for c in (f"MACD_{f}_{s}", f"MACD_Signal_{f}_{s}_{g}", f"MACD_Hist_{f}_{s}_{g}")]
    + [_bbn(kind, n, k) for n, k in BB_S for kind in ("Upper", "Lower", "Width", "Position")]
    + ["Price_Range", "Price_Position", "Gap", "Gap_Percent"]
    + [c for n in VOLA_P for c in (f"Volatility_{n}", f"ATR_{n}")]
    + [c for n in VOLU_P for c in (f"Volume_SMA_{n}", f"Volume_Ratio_{n}", f"Price_Volume_{n}", f"VWAP_{n}")]
    + [c for n in MOM_P for c in (f"Momentum_{n}", f"ROC_{n}")]
    + [c for n in SR_P for c in (f"Resistance_{n}", f"Support_{n}", f"Support_Resistance_Ratio_{n}")]
    + [c for n in TREND_P for c in (f"Trend_{n}", f"Upper_Shadow_{n}", f"Lower_Shadow_{n}")])


def complete_where() -> str:
    return " AND ".join(f"({c} IS NOT NULL AND NOT isnan({c}))" for c in ADVANCED_NAMES)


LOCAL = """
SELECT date, symbol, open, high, low, close, volume,
       CASE WHEN rn >= 5 THEN {r_sma} END AS sma_5,
       CASE WHEN rn >= 5 THEN {r_ret} END AS return_1d,
       CASE WHEN rn >= 5 THEN {r_vol} END AS volatility_5d,
       volume / 1000000.0 AS volume_normalized
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS rn,
             {ret} AS ret
      FROM bars)
WINDOW w5 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
""".format(ret=div("close - lag(close) OVER (PARTITION BY symbol ORDER BY date)",
                   "lag(close) OVER (PARTITION BY symbol ORDER BY date)"),
           r_sma=rnd("avg(close) OVER w5", 2), r_ret=rnd("ret", 4), r_vol=rnd("stddev_pop(ret) OVER w5", 4))

LOCAL_META = """
SELECT symbol, 'sma_5' AS technical_indicators, 'return_1d;volatility_5d' AS price_features,
       'volume_normalized' AS volume_features, 4 AS total_features, count(*) AS original_records, count(*) AS processed_records,
       4 AS features_added, 'local_processing' AS method
FROM bars GROUP BY symbol
"""

ADV_META = """
WITH a AS ({adv})
SELECT symbol, CAST(count_if({complete}) AS BIGINT) AS Records_Count, count(*) AS Original_Records,
       87 AS Features_Count, 87 AS features_created
FROM a GROUP BY symbol
""".format(adv=advanced_sql(ADVANCED_NAMES, {}).replace("WITH RECURSIVE", "WITH RECURSIVE", 1),
           complete=complete_where())


EXPECTED_SYMBOLS = "SELECT o_orderpriority AS symbol FROM orders UNION SELECT event_type FROM events"

GRADE = ("CASE WHEN passed_checks = total_checks THEN 'EXCELLENT' "
         "WHEN passed_checks >= total_checks * 0.75 THEN 'GOOD' "
         "WHEN passed_checks >= total_checks * 0.5 THEN 'FAIR' ELSE 'POOR' END")

QUALITY_CTE = f"""
c AS (SELECT symbol, count(*) AS record_count, count(DISTINCT date) AS nd,
             bool_and(open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL
                      AND close IS NOT NULL AND volume IS NOT NULL) AS required_fields
      FROM bars GROUP BY symbol),
g AS (SELECT *, record_count >= 10 AS sufficient_records, record_count > 0 AS data_structure,
             nd = record_count AS unique_dates,
             CAST(record_count >= 10 AS INTEGER) + CAST(record_count > 0 AS INTEGER)
               + CAST(required_fields AS INTEGER) AS passed_checks,
             3 AS total_checks
      FROM c),
exp AS ({EXPECTED_SYMBOLS}),
report AS (
  SELECT exp.symbol, coalesce(record_count, 0) AS record_count, record_count IS NOT NULL AS data_exists,
         sufficient_records, data_structure, required_fields, unique_dates,
         coalesce(passed_checks, 0) AS passed_checks, coalesce(total_checks, 1) AS total_checks,
         CASE WHEN record_count IS NULL THEN 'POOR' ELSE {GRADE} END AS overall_quality,
         CASE WHEN record_count IS NULL THEN NULL ELSE {GRADE} IN ('EXCELLENT', 'GOOD') END AS validation_passed,
         CASE WHEN record_count IS NULL THEN 'No valid data found' ELSE '' END AS issues
  FROM exp LEFT JOIN g ON exp.symbol = g.symbol)"""

QUALITY_REPORT = with_bars(f", {QUALITY_CTE}\nSELECT * FROM report").replace(")\n, ", "),\n", 1)

INGESTION_GATE = with_bars(f", {QUALITY_CTE}\nSELECT * FROM bars WHERE symbol IN "
                           "(SELECT symbol FROM report WHERE validation_passed AND data_exists)"
                           ).replace(")\n, ", "),\n", 1)

INGESTION_STATS = with_bars(f", {QUALITY_CTE}\nSELECT count(DISTINCT symbol) AS symbols_processed, "
                            "avg(CAST(coalesce(validation_passed, false) AS DOUBLE)) AS success_rate FROM report"
                            ).replace(")\n, ", "),\n", 1)

PRICE_VOLUME_RANGE = with_bars("""
SELECT symbol, count(*) AS bar_count, min(low) AS min_low, max(high) AS max_high,
       min(volume) AS min_volume, max(volume) AS max_volume, min(date) AS first_date, max(date) AS last_date
FROM bars GROUP BY symbol""")

ROW_COUNTS = with_bars("SELECT symbol, count(*) AS record_count FROM bars GROUP BY symbol")

DAILY_NAMES = ["sma_5", "sma_20", "price_change", "price_change_pct", "volatility_5d",
               "volume_sma_5", "high_low_ratio"]


def completeness_sql(source: str, names: list[str]) -> str:
    filled = " + ".join(f"CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) THEN 1 ELSE 0 END" for c in names)
    return (f"SELECT symbol, count(*) AS record_count, "
            f"sum({filled}) / (count(*) * {len(names)}) AS completeness FROM ({source}) GROUP BY symbol")


PREP_ALIASES = {"sma_20": "SMA_20", "rsi_14": "RSI_14", "macd": "MACD_12_26",
                "volatility": "Volatility_20", "volume_sma": "Volume_SMA_20",
                "volume_ratio": "Volume_Ratio_20"}
PREP_NAMES = ["sma_20", "rsi_14", "macd", "returns", "volatility", "volume_sma", "volume_ratio"]
PREP_DIGITS = {"sma_20": 6, "rsi_14": 6, "macd": 2, "volatility": 6, "volume_sma": 6, "volume_ratio": 6}


def prep_sql(bars: str = BARS_ORDERS) -> str:
    return advanced_sql(["close"] + PREP_NAMES, PREP_DIGITS, bars=bars, aliases=PREP_ALIASES)


def prep_completeness_sql(bars: str = BARS_ORDERS) -> str:
    src = advanced_sql(PREP_NAMES, {}, bars=bars, aliases=PREP_ALIASES)
    inner = completeness_sql("SELECT * FROM adv_sel", PREP_NAMES)
    # wrap: the advanced query becomes a CTE named adv_sel
    head, _, tail = src.rpartition("\nSELECT ")
    return f"{head},\nadv_sel AS (SELECT {tail})\nSELECT symbol, record_count, {rnd('completeness', 6)} AS completeness FROM ({inner})"


def training_gate_sql(bars: str = BARS_ORDERS) -> str:
    src = advanced_sql(PREP_NAMES, {}, bars=bars, aliases=PREP_ALIASES)
    head, _, tail = src.rpartition("\nSELECT ")
    comp = completeness_sql("SELECT * FROM adv_sel", PREP_NAMES)
    return (f"{head},\nadv_sel AS (SELECT {tail}),\ncomp AS ({comp})\n"
            f"SELECT symbol, date FROM adv_sel WHERE symbol IN (SELECT symbol FROM comp WHERE completeness >= 0.8)")


ZSCORE = with_bars("""
SELECT symbol, date, close,
       {z} AS close_z
FROM bars""".format(z=rnd(div("close - " + full("avg", "close", 20), full("stddev_samp", "close", 20)), 6)))

OUTLIERS = with_bars("""
SELECT symbol, date, close FROM (
  SELECT symbol, date, close, {z} AS z FROM bars)
WHERE z IS NULL OR abs(z) <= 3.0""".format(
    z=div("close - " + full("avg", "close", 20), full("stddev_samp", "close", 20))))

FFILL = with_bars("""
SELECT symbol, date,
       last_value(pp IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_position
FROM (SELECT symbol, date, {pp} AS pp FROM bars)""".format(pp=div("close - low", "high - low")))


def _run_log_cte() -> str:
    daily_src = DAILY.strip()
    return f"""
{QUALITY_CTE},
daily AS ({daily_src}),
comp AS ({completeness_sql("SELECT * FROM daily", DAILY_NAMES)}),
spans AS (SELECT symbol, CAST(min(date) AS TIMESTAMP) AS first_ts, CAST(max(date) AS TIMESTAMP) AS last_ts
          FROM bars GROUP BY symbol),
r AS (SELECT report.symbol, coalesce(validation_passed, false) AS ing_ok,
             coalesce(comp.completeness >= 0.8, false) AS prep_ok, overall_quality, completeness,
             coalesce(first_ts, last_ts) AS created_at, coalesce(last_ts, first_ts) AS updated_at
      FROM report LEFT JOIN comp ON report.symbol = comp.symbol LEFT JOIN spans ON report.symbol = spans.symbol),
log AS (
  SELECT symbol AS workflow_id, 'ingestion' AS stage,
         CASE WHEN ing_ok THEN 'completed' ELSE 'failed' END AS status, created_at, updated_at,
         CASE WHEN ing_ok THEN 0 ELSE 1 END AS n_err,
         CASE WHEN ing_ok THEN NULL ELSE 'validation_error' END AS err_type,
         CASE WHEN ing_ok THEN NULL ELSE 'ingestion' END AS err_node
  FROM r
  UNION ALL
  SELECT symbol, 'preprocessing',
         CASE WHEN NOT ing_ok THEN 'pending' WHEN prep_ok THEN 'completed' ELSE 'failed' END,
         created_at, updated_at,
         CASE WHEN ing_ok AND NOT prep_ok THEN 1 ELSE 0 END,
         CASE WHEN ing_ok AND NOT prep_ok THEN 'completeness_error' END,
         CASE WHEN ing_ok AND NOT prep_ok THEN 'preprocessing' END
  FROM r
  UNION ALL
  SELECT symbol, 'training', CASE WHEN ing_ok AND prep_ok THEN 'running' ELSE 'pending' END,
         created_at, updated_at, 0, NULL, NULL
  FROM r)"""


def _run_log_query(body: str) -> str:
    return with_bars(f", {_run_log_cte()}\n{body}").replace(")\n, ", "),\n", 1)


RUN_STATUS = _run_log_query("""
SELECT workflow_id,
       CASE WHEN bool_or(stage = 'training' AND status = 'completed') THEN 'completed'
            WHEN bool_or(status = 'failed') THEN 'failed'
            WHEN bool_or(status = 'running') THEN 'running' ELSE 'pending' END AS status
FROM log GROUP BY workflow_id""")

RUN_PROGRESS = _run_log_query("""
SELECT workflow_id, CAST(count_if(status = 'completed') AS BIGINT) AS completed_stages,
       count(*) AS total_stages,
       CAST(epoch(max(updated_at)) - epoch(min(created_at)) AS DOUBLE) AS elapsed_seconds
FROM log GROUP BY workflow_id""")

ERROR_LOG = _run_log_query("""
SELECT coalesce(err_node, 'global') AS node, count(*) AS error_count,
       count(DISTINCT workflow_id) AS workflows, string_agg(DISTINCT err_type, ';' ORDER BY err_type) AS error_types
FROM log WHERE n_err > 0 GROUP BY 1""")


def ratios_sql(columns: list[str], digits: int) -> str:
    """Advanced columns over the close, to more places than :func:`advanced_sql` compares."""
    return advanced_sql(columns, dict.fromkeys(columns, digits), aliases={c: div(c, "close") for c in columns})


OUTPUT_MANIFEST = """
SELECT count(*) > 0 AS ok, count(*) > 0 AS has_files,
       CAST(sum(strlen(o_orderkey || '|' || o_orderpriority) + 1) AS BIGINT) AS total_bytes FROM orders
UNION ALL SELECT false, false, 0"""

OUTPUT_ANALYSIS = with_bars("""
SELECT count(*) AS records,
       'sma_5;sma_20;price_change;price_change_pct;volatility_5d;volume_sma_5;high_low_ratio' AS feature_columns,
       7 AS feature_count, first(symbol ORDER BY symbol, date) AS sample_symbol,
       CAST(first(date ORDER BY symbol, date) AS VARCHAR) AS sample_date,
       first(close ORDER BY symbol, date) AS sample_close, true AS ok, true AS sized FROM bars""")

ZONE_PATHS = """
SELECT DISTINCT 'base/raw_data/daily/' || o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m') || '.json' AS raw,
       'base/processed_data/daily/' || o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m') || '.json' AS processed
FROM orders"""

FFILL_GAPS = with_bars("""
SELECT symbol, date,
       last_value(c IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close
FROM (SELECT symbol, date, CASE WHEN day(date) <= 2 THEN close END AS c FROM bars)""")

CUSTOMER_BARS = """
SELECT date, symbol, CASE WHEN key % 7 != 0 THEN open END AS open, high, low, close,
       CASE WHEN key % 5 != 0 OR day(date) % 2 = 0 THEN volume END AS volume
FROM (SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey AS VARCHAR) AS symbol, o_custkey AS key,
             arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
             arg_max(o_totalprice, o_orderkey) AS close, CAST(sum(floor(o_totalprice)) AS BIGINT) AS volume
      FROM orders GROUP BY 1, 2, 3)"""

_CUSTOMER_CTE = QUALITY_CTE.replace(EXPECTED_SYMBOLS, "SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer")

CUSTOMER_REPORT = f"WITH bars AS ({CUSTOMER_BARS}), {_CUSTOMER_CTE}\nSELECT * FROM report"

CUSTOMER_GATE = (f"WITH bars AS ({CUSTOMER_BARS}), {_CUSTOMER_CTE}\n"
                 "SELECT * FROM bars WHERE symbol IN (SELECT symbol FROM report WHERE validation_passed AND data_exists)")

CUSTOMER_TRAINING_GATE = (
    f"WITH bars AS ({CUSTOMER_BARS}), feats AS ({DAILY.strip()}),\n"
    f"comp AS ({completeness_sql('SELECT * FROM feats', DAILY_NAMES)})\n"
    "SELECT symbol, date FROM feats WHERE symbol IN (SELECT symbol FROM comp WHERE completeness >= 0.8)")

RUN_LOG_FOLDED = """
WITH event AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS workflow_id, stage, "at", status, failed FROM (
    SELECT l_orderkey, 'ingestion' AS stage, CAST(l_shipdate AS TIMESTAMP) AS "at", 'completed' AS status, NULL AS failed
    FROM lineitem
    UNION ALL
    SELECT l_orderkey, 'preprocessing', CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1 DAY,
           CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'running' END, NULL FROM lineitem
    UNION ALL
    SELECT l_orderkey, 'training', CAST(l_shipdate AS TIMESTAMP) + to_days(CAST(l_linenumber AS INTEGER)),
           CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'completed' END,
           CASE WHEN l_returnflag = 'R' THEN (l_linenumber, l_shipdate) END FROM lineitem)),
log AS (
  SELECT workflow_id, stage, max(("at", status)) AS last, min("at") AS created_at, max("at") AS updated_at,
         count(DISTINCT failed) AS errors
  FROM event GROUP BY workflow_id, stage)
SELECT workflow_id,
       CASE WHEN bool_or(stage = 'training' AND last[2] = 'completed') THEN 'completed'
            WHEN bool_or(last[2] = 'failed') THEN 'failed'
            WHEN bool_or(last[2] = 'running') THEN 'running' ELSE 'pending' END AS status,
       CAST(count_if(last[2] = 'completed') AS BIGINT) AS completed_stages, count(*) AS total_stages,
       CAST(epoch(max(updated_at)) - epoch(min(created_at)) AS DOUBLE) AS elapsed_seconds,
       CAST(sum(errors) AS BIGINT) AS errors
FROM log GROUP BY workflow_id"""
