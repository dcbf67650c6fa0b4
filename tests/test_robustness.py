"""Restarts, awkward inputs and missing values: nothing may be lost silently."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from barsmith.operators import clean
from barsmith.operators.bars import bars_from_ticks
from barsmith.functions.windows import Layout
from barsmith.plans import jobs
from barsmith.sources import readers, sinks
from helpers import ohlc

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

STREAM = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from barsmith.session import get_session
from barsmith.streaming.bars_stream import start_bar_sink, stream_bars, tick_stream
spark = get_session("local[2]", 2, extra={{"spark.checkpoint.dir": {shared!r}}})
ticks = tick_stream(spark, {src!r}, "tick long, sym string, ts timestamp, price double")
bars = stream_bars(ticks.withColumn("one", F.lit(1)), "sym", "ts", "price", "one", "tick", "hour", "0 seconds")
start_bar_sink(bars, {out!r}, available_now=True).awaitTermination(120)
"""


def test_stream_resumes_in_another_driver_with_new_files(spark, tmp_path):
    src, out, shared = (str(tmp_path / x) for x in ("ticks", "bars", "shared"))
    code = STREAM.format(repo=REPO, src=src, out=out, shared=shared)
    for start in (0, 240):
        ticks = spark.range(start, start + 240).select(
            F.col("id").alias("tick"), F.lit("A").alias("sym"),
            F.timestamp_seconds(F.col("id") * 600).alias("ts"), F.col("id").cast("double").alias("price"))
        ticks.coalesce(1).write.mode("append").parquet(src)
        subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=200)
    got = spark.read.parquet(out)
    assert got.count() == got.select("date").distinct().count() == 79  # every hour but the open one


def test_hourly_bars_keep_their_time(spark, tmp_path):
    bars = spark.range(30).select(
        F.timestamp_seconds(F.col("id") * 3600).alias("date"), F.lit("A").alias("symbol"),
        *[F.lit(1.5).alias(c) for c in ("open", "high", "low", "close")], F.lit(7).cast("bigint").alias("volume"))
    want = sorted(r["date"] for r in bars.collect())

    def times(df):
        return sorted(r["date"] for r in df.collect())
    assert times(readers.as_bars(readers.read_table(spark, sinks.write_parquet(bars, str(tmp_path / "p")), "parquet"))) == want
    assert times(readers.as_bars(readers.read_table(spark, sinks.write_csv(bars, str(tmp_path / "c")), "csv"))) == want
    assert times(readers.read_bars_ndjson(spark, sinks.write_ndjson(bars, str(tmp_path / "n")))) == want
    assert times(readers.read_envelopes(spark, sinks.write_envelopes(bars, str(tmp_path / "e")))) == want
    vendor = sinks.write_vendor_documents(bars, str(tmp_path / "v"))
    assert times(readers.read_vendor_series(spark, vendor, timed=True)) == want


def test_tables_keep_all_columns(spark, tmp_path):
    wide = ohlc(spark, "R", [(1.0, 2.0, 0.5, 1.5, 10)]).withColumn("SMA_5", F.lit(3.25))
    for fmt in ("parquet", "csv"):
        back = readers.read_table(spark, sinks.write_table(wide, str(tmp_path / fmt), fmt), fmt)
        assert back.columns == wide.columns and back.first()["SMA_5"] == 3.25


def test_indented_envelope_documents(spark, tmp_path):
    env = {"success": True, "symbol": "E", "data": [{"date": "2024-01-0%d" % d, "close": 1.5, "volume": "3.0"} for d in (1, 2)]}
    (tmp_path / "a.json").write_text(json.dumps(env, indent=2))
    rows = readers.read_envelopes(spark, str(tmp_path), document=True).collect()
    assert len(rows) == 2 and {r["symbol"] for r in rows} == {"E"} and {r["volume"] for r in rows} == {3}


def test_jobs_read_either_envelope_form_keep_times_and_count_malformed_input(spark, tmp_path):
    def envelope(symbol, times):
        bars = [{"date": t, "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 3} for t in times]
        return {"success": True, "symbol": symbol, "record_count": len(bars), "data": bars}
    hours = ["2024-01-01"] + ["2024-01-01T%02d:00:00" % h for h in range(1, 6)]
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(json.dumps(envelope("A", hours), indent=2))
    (src / "b.json").write_text("\n".join(json.dumps(envelope(s, hours)) for s in "BC") + "\n{oops\n")
    (src / "c.json").write_text('{"success": \n nonsense')
    bars = readers.read_envelopes(spark, str(src), document=None)
    assert bars.groupBy("symbol").agg(F.count_distinct("date").alias("n")).where("n = 6").count() == 3
    expected = spark.createDataFrame([(s,) for s in "ABC"], "symbol string")
    out = jobs.ingestion_job(spark, str(src), expected, str(tmp_path / "zones"), "s1")
    assert {r["symbol"]: r["record_count"] for r in spark.read.parquet(out["report"]).collect()} == dict.fromkeys("ABC", 6)
    counts = spark.read.json(out["malformed"] + "/counts").collect()
    assert sorted((r["path"][-6:], r["malformed"]) for r in counts) == [("b.json", 1), ("c.json", 1)]

    lines = [json.dumps({"symbol": "A", **b}) for b in envelope("A", hours)["data"]]
    (tmp_path / "bars.ndjson").write_text("\n".join([*lines, "nonsense"]))
    daily_out = jobs.daily_job(spark, str(tmp_path / "bars.ndjson"), str(tmp_path / "daily"))
    assert spark.read.json(daily_out).select("date").distinct().count() == 6
    assert [r["malformed"] for r in spark.read.json(f"{daily_out}_malformed/counts").collect()] == [1]


def test_numbers_as_text_and_malformed_lines(spark, tmp_path):
    p = tmp_path / "bars.ndjson"
    p.write_text('{"date": "2024-01-01", "symbol": "A", "close": "1.5", "volume": 1000.0}\n{"date": \nnonsense\n\n')
    rows = readers.read_bars_ndjson(spark, str(p)).collect()
    assert len(rows) == 1 and rows[0]["volume"] == 1000 and rows[0]["close"] == 1.5
    assert readers.malformed_lines(spark, str(p)).count() == 2
    with pytest.raises(Exception):
        readers.read_bars_ndjson(spark, str(p), strict=True, timed=False).collect()


def test_advanced_job_numeric_symbols_and_no_complete_row(spark, tmp_path):
    def rows(n):
        return [(1.0 + i % 7, 2.0 + i % 7, 0.5 + i % 5, 1.5 + i % 9, 100 + i) for i in range(n)]
    two = ohlc(spark, "0700", rows(220)).unionByName(ohlc(spark, "700", rows(230)))
    res = jobs.advanced_job(spark, sinks.write_vendor_documents(two, str(tmp_path / "v")), str(tmp_path / "o"))
    meta = {r["Symbol"]: r for r in spark.read.schema("Symbol string, Records_Count long, Processing_Date string, "
                                                      "processor string").json(res["metadata"]).collect()}
    assert meta["0700"]["Records_Count"] == 21 and meta["700"]["Records_Count"] == 31
    assert meta["700"]["Processing_Date"] and meta["700"]["processor"]
    few = ohlc(spark, "F", rows(50))
    res = jobs.advanced_job(spark, sinks.write_vendor_documents(few, str(tmp_path / "v2")), str(tmp_path / "o2"))
    assert spark.read.json(res["metadata"]).first()["Records_Count"] == 0


def test_nan_ticks_are_missing(spark):
    rows = [(1, 5.0), (2, float("nan")), (3, 4.0)]
    ticks = spark.createDataFrame([(i, "A", p) for i, p in rows], "tick long, sym string, price double").withColumn(
        "ts", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    bar = bars_from_ticks(ticks, "sym", "ts", "price", F.lit(1), "tick").first()
    assert (bar["open"], bar["high"], bar["low"], bar["close"], bar["volume"]) == (5.0, 5.0, 4.0, 4.0, 3)


def test_forward_fill_of_a_null_symbol_across_chunks(spark):
    rows = [(None, i, 1.0 if i == 0 else (float("nan") if i % 2 else None)) for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, i int, close double").select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("date"), "symbol", "close")
    filled = clean.forward_fill(df, ["close"], Layout(chunk_rows=8))
    assert filled.count() == 40 and filled.where("close = 1.0").count() == 40


def test_manifest_of_a_missing_path(spark, tmp_path):
    row = sinks.output_manifest(spark, str(tmp_path / "nothing")).first()
    assert row["ok"] is False and row["file_count"] == 0
