"""Series cut into chunks, block-wise rolling aggregates, and passes by need."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsmith.functions import windows
from barsmith.functions.ema import EmaPlan
from barsmith.functions.rolling import Roll, add_rolling, rolling_lookback
from barsmith.functions.windows import BASE, CHUNK, RN, Layout, finish, segment
from barsmith.operators import advanced as adv
from barsmith.operators import clean
from barsmith.schema import BAR
from helpers import day, ohlc
from test_advanced import compare, random_series


def second_bars(spark, n, symbol="S"):
    """One bar a second in bursts: an hour of every day, like a market that opens briefly."""
    i = F.col("id")
    at = F.floor(i / 3600) * 86400 + i % 3600
    return spark.range(n).select(F.timestamp_seconds(at).alias("date"), F.lit(symbol).alias("symbol"),
                                 *[(i % 97).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                                 (i % 50).alias("volume"))


def plan_of(df):
    conf = df.sparkSession.conf
    conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.unset("spark.sql.debug.maxToStringFields")


def test_buckets_follow_the_density_of_a_series(spark):
    layout = Layout(chunk_rows=2000)
    bars = second_bars(spark, 40_000).unionByName(
        ohlc(spark, "DAILY", random_series(300, 1)).withColumn("date", F.col("date").cast("timestamp")))
    parts = segment(bars, 20, layout)
    sizes = {(r["symbol"], r[CHUNK]): r["n"] for r in parts.groupBy("symbol", CHUNK).agg(F.count("*").alias("n")).collect()}
    assert len([k for k in sizes if k[0] == "S"]) >= 19 and ("DAILY", 0) in sizes and len(sizes) < 40
    # chunk, look-back and one bucket (an eighth of a chunk by the sketch)
    assert max(sizes.values()) <= 2000 + 20 + 2 * 2000 // windows.BUCKETS_PER_CHUNK
    own = parts.where(f"symbol = 'S' and not {windows.HALO}")
    assert own.count() == 40_000 == own.select(RN).distinct().count()
    late = own.orderBy(F.desc("date")).first()
    assert late[RN] == 39_999


def test_short_series_are_one_chunk_without_a_join(spark):
    parts = segment(ohlc(spark, "A", random_series(50, 2)), 20)
    assert "Join" not in plan_of(parts)
    assert [tuple(r) for r in parts.select(CHUNK, BASE).distinct().collect()] == [(0, 0)]


def test_dateless_bars_are_dealt_over_chunks(spark):
    rows = [(None, "N", float(i), 0.0, 0.0, float(i), 1) for i in range(900)]
    rows += [(day(i), "N", float(i), 0.0, 0.0, float(i), 1) for i in range(300)]
    bars = spark.createDataFrame(rows, BAR)
    parts = segment(bars, 3, Layout(chunk_rows=200))
    own = parts.where(f"not {windows.HALO}")
    assert own.count() == 1200 == own.select(RN).distinct().count()
    assert own.where("date is null").agg(F.max(RN)).first()[0] == 899
    assert parts.groupBy(CHUNK).count().agg(F.max("count")).first()[0] < 400


@pytest.mark.parametrize("level", [0.0, 1e6])
@pytest.mark.parametrize("layout", [Layout(), Layout(chunk_rows=64)])
def test_rolling_spread_and_extremes(spark, level, layout):
    rng = np.random.default_rng(3)
    values = [None if rng.random() < 0.02 else level + float(rng.normal(0, 1)) for _ in range(600)]
    df = spark.createDataFrame([(day(i), "R", v) for i, v in enumerate(values)], "date date, symbol string, x double")
    rolls = [Roll(f"{kind}{n}", kind, "x", n) for kind in ("stddev", "max", "min") for n in (4, 16, 17, 20, 31, 32, 33, 50, 130)]
    s = segment(df, rolling_lookback(rolls), layout)
    out = add_rolling(s, rolls, EmaPlan("symbol", ()))
    plan = plan_of(out)
    assert "RowFrame, -3, currentrow" in plan and "RowFrame, -19, currentrow" not in plan
    got = finish(out).orderBy("date").toPandas()
    x = pd.Series(values, dtype=float)
    for r in rolls:
        part = [x[i - r.n + 1:i + 1] if i >= r.n - 1 else x[:0] for i in range(len(x))]
        want = pd.Series([np.nan if len(p) < r.n or p.isna().any() else
                          {"stddev": lambda v: np.std(v - level, ddof=1), "max": np.max, "min": np.min}[r.kind](p.to_numpy())
                          for p in part])
        have = got[r.out].astype(float)
        assert (have.isna() == want.isna()).all(), r
        assert np.allclose(have[have.notna()], want[want.notna()], rtol=1e-9, atol=0), r


def test_columns_by_need_equal_those_of_the_full_set(spark):
    rows = random_series(260, 4)
    bars = ohlc(spark, "B", rows)
    full = adv.advanced_features(bars).orderBy("date").toPandas()
    for family, columns in adv.FAMILIES.items():
        part = adv.advanced_features(bars, columns=columns)
        assert part.columns == [*bars.columns, *columns]
        pd.testing.assert_frame_equal(part.orderBy("date").toPandas()[columns], full[columns], rtol=1e-12, obj=family)
    with pytest.raises(ValueError):
        adv.advanced_features(bars, columns=["SMA_7"])


def test_lookback_and_passes_by_need(spark):
    assert adv.lookback_rows(adv.FAMILIES["rsi"]) == 31
    assert adv.lookback_rows(adv.FAMILIES["price"]) == 1
    assert adv.lookback_rows(["EMA_5"]) < adv.lookback_rows(["EMA_200"]) == adv.lookback_rows() - 0
    bars = ohlc(spark, "P", random_series(60, 5))

    def windows_in(df):
        return plan_of(df).count("Window [")
    everything = windows_in(adv.advanced_features(bars))
    assert windows_in(adv.advanced_features(bars, columns=adv.FAMILIES["rsi"])) < everything / 2
    assert windows_in(clean.prep_features(bars)) < everything
    assert "RowFrame, -49, currentrow" not in plan_of(adv.advanced_features(bars))


def test_chunked_families_match_the_definitions(spark):
    rows = random_series(3000, 6)
    layout = Layout(chunk_rows=128)
    columns = adv.FAMILIES["support_resistance"] + adv.FAMILIES["volatility"] + adv.FAMILIES["bbands"]
    bars = ohlc(spark, "C", rows)
    cut = adv.advanced_features(bars, layout, columns=columns).orderBy("date").toPandas()
    whole = adv.advanced_features(bars, columns=columns).orderBy("date").toPandas()
    pd.testing.assert_frame_equal(cut[columns], whole[columns], rtol=1e-9)
    compare(adv.advanced_features(bars), {"C": rows})


@pytest.mark.parametrize("level", [0.0, 1e6])
def test_zscore_at_a_large_level(spark, level):
    rng = np.random.default_rng(8)
    values = level + rng.normal(0, 1, 200)
    df = spark.createDataFrame([(day(i), "Z", float(v)) for i, v in enumerate(values)], "date date, symbol string, x double")
    got = clean.zscore(df, "x").orderBy("date").toPandas()["x_z"]
    x = pd.Series(values - level)
    want = (x - x.rolling(20).mean()) / x.rolling(20).std()
    assert (got.isna() == want.isna()).all()
    assert np.allclose(got.dropna(), want.dropna(), rtol=1e-7, atol=1e-8)


def test_forward_fill_is_one_window_pass_over_the_bars(spark):
    rows = [(day(i), "G", None if i % 50 else float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "date date, symbol string, v double")
    out = clean.forward_fill(df, ["v"], Layout(chunk_rows=20))
    assert plan_of(out).count("Window [") == 1
    assert {r["date"]: r["v"] for r in out.collect()} == {day(i): float(i - i % 50) for i in range(400)}


def test_forward_fill_keeps_values_of_dateless_rows(spark):
    df = spark.createDataFrame([(None, "N", 7.0), (dt.date(2024, 1, 1), "N", None)], "date date, symbol string, v double")
    assert [r["v"] for r in clean.forward_fill(df, ["v"]).collect()] == [7.0, 7.0]
