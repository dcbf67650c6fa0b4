import json

import pytest
from pyspark.sql import functions as F

from barsmith.plans import jobs
from barsmith.sources import readers, sinks
from helpers import by_symbol_date, day, ohlc


def _vendor_doc(symbol, series):
    doc = {"Time Series (Daily)": {d: {"1. open": str(o), "2. high": str(h), "3. low": str(lo),
                                        "4. close": str(c), "5. volume": str(v)}
                                   for d, (o, h, lo, c, v) in series.items()}}
    if symbol is not None:
        doc["Meta Data"] = {"1. Information": "Daily Prices", "2. Symbol": symbol}
    return json.dumps(doc, indent=2)


def test_ndjson_missing_key_and_string_date(spark, tmp_path):
    p = tmp_path / "bars.ndjson"
    p.write_text('{"date": "2024-01-02", "symbol": "A", "open": 1, "high": 2, "low": 0.5, "close": 1.5}\n'
                 '{"date": "2024-01-01", "symbol": "A", "open": 1, "high": 2, "low": 0.5, "close": 1.2, '
                 '"volume": 7}\n')
    rows = by_symbol_date(readers.read_bars_ndjson(spark, str(p)))
    assert rows[("A", day(1))]["volume"] is None and rows[("A", day(0))]["volume"] == 7
    assert rows[("A", day(0))]["close"] == 1.2


def test_vendor_documents(spark, tmp_path):
    d = tmp_path / "vendor"
    d.mkdir()
    (d / "a.json").write_text(_vendor_doc("AAA", {"2024-01-02": (1, 2, 0.5, 1.5, 10),
                                                  "2024-01-01": (1.1, 2.1, 0.6, 1.6, 11)}))
    (d / "b.json").write_text(_vendor_doc(None, {"2024-01-01": (3, 4, 2, 3.5, 30)}))
    (d / "c.json").write_text(json.dumps({"Meta Data": {"2. Symbol": "EMPTY"}}))
    (d / "notes.txt").write_text("not json")
    rows = by_symbol_date(readers.read_vendor_series(spark, str(d)))
    assert set(rows) == {("AAA", day(1)), ("AAA", day(0)), ("Unknown", day(0))}
    assert rows[("AAA", day(0))]["volume"] == 11 and rows[("Unknown", day(0))]["close"] == 3.5


def test_vendor_errors(spark, tmp_path):
    empty = tmp_path / "none"
    empty.mkdir()
    with pytest.raises(ValueError):
        readers.read_vendor_series(spark, str(empty))
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.json").write_text(_vendor_doc("X", {"2024-01-01": ("abc", 2, 1, 1.5, 5)}))
    lenient = readers.read_vendor_series(spark, str(bad), lenient=True).first()
    assert lenient["open"] is None and lenient["close"] == 1.5
    with pytest.raises(Exception):
        readers.read_vendor_series(spark, str(bad)).collect()


def test_envelopes(spark, tmp_path):
    env = {"success": True, "symbol": "E", "record_count": 2, "metadata": {"source": "x"},
           "fetch_timestamp": "2024-01-03T00:00:00",
           "data": [{"date": "2024-01-01", "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 3},
                    {"date": "2024-01-02", "symbol": "E", "open": 1, "high": 2, "low": 0.5, "close": 1.7,
                     "volume": 4}]}
    failed = {"success": False, "symbol": "F", "data": [{"date": "2024-01-01", "close": 9}]}
    p = tmp_path / "env.json"
    p.write_text(json.dumps(env) + "\n" + json.dumps(failed) + "\n")
    rows = by_symbol_date(readers.read_envelopes(spark, str(p)))
    assert set(rows) == {("E", day(0)), ("E", day(1))}
    dl = tmp_path / "download.json"
    dl.write_text(json.dumps({"success": True, "key": "raw_data/daily/E/latest.json", "data": env}) + "\n")
    assert readers.read_envelopes(spark, str(dl), download=True).count() == 2


def test_format_switch_and_roundtrips(spark, tmp_path):
    df = ohlc(spark, "R", [(1.0, 2.0, 0.5, 1.5, 10), (1.5, 2.5, 1.0, 2.0, 20)])
    for fmt in ("parquet", "CSV"):
        path = sinks.write_table(df, str(tmp_path / fmt), fmt)
        assert sorted(readers.read_table(spark, path, fmt).collect()) == sorted(df.collect())
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path), "xlsx")
    with pytest.raises(ValueError):
        sinks.write_table(df, str(tmp_path / "x"), "xlsx")
    txt = sinks.write_text(df.select(F.col("symbol").alias("value")), str(tmp_path / "txt"))
    assert "R" in "".join(r["value"] for r in readers.read_text(spark, txt).collect())
    js = sinks.write_json_documents(df, str(tmp_path / "docs"))
    assert readers.read_json_document(spark, js).count() >= 1


def test_snapshots_latest_and_history(spark, tmp_path):
    a = ohlc(spark, "A", [(1.0, 2.0, 0.5, 1.5, 10)] * 3)
    b = ohlc(spark, "B", [(1.0, 2.0, 0.5, 1.5, 10)] * 2)
    base = str(tmp_path / "zones")
    sinks.write_snapshot(a.union(b), base, "20240101_000000")
    paths = sinks.write_snapshot(a.limit(1), base, "20240102_000000")
    latest = {r["symbol"]: r["n"] for r in spark.read.json(paths["latest"]).groupBy("symbol")
              .agg(F.count("*").alias("n")).collect()}
    assert latest == {"A": 1, "B": 2}
    hist = spark.read.json(paths["history"])
    assert hist.select("snapshot").distinct().count() == 2
    assert sinks.zone_path("raw_data/daily/A/latest.json") == "processed_data/daily/A/latest.json"
    man = sinks.output_manifest(spark, paths["latest"]).first()
    assert man["ok"] and man["file_count"] > 0 and man["total_bytes"] > 0


def test_snapshot_retry_replaces_its_own_snapshot(spark, tmp_path):
    a = ohlc(spark, "A", [(1.0, 2.0, 0.5, 1.5, 10)] * 3)
    b = ohlc(spark, "B", [(1.0, 2.0, 0.5, 1.5, 10)] * 2)
    base = str(tmp_path / "zones")
    sinks.write_snapshot(a, base, "s1")
    sinks.write_snapshot(a.union(b), base, "s2")
    paths = sinks.write_snapshot(a.union(b), base, "s2")  # the same job run again
    hist = {(r["symbol"], r["snapshot"]): r["n"] for r in spark.read.json(paths["history"])
            .groupBy("symbol", "snapshot").agg(F.count("*").alias("n")).collect()}
    assert hist == {("A", "s1"): 3, ("A", "s2"): 3, ("B", "s2"): 2}
    latest = spark.read.json(paths["latest"])
    assert latest.count() == 5 and "snapshot" not in latest.columns
    got = latest.select("symbol", F.to_date("date").alias("date"), "open", "high", "low", "close", "volume")
    want = a.union(b).select("symbol", "date", "open", "high", "low", "close", "volume")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_jobs_end_to_end(spark, tmp_path):
    rows = [(1.0 + i % 7, 2.0 + i % 7, 0.5 + i % 5, 1.5 + i % 9, 100 + i) for i in range(220)]
    df = ohlc(spark, "J", rows)
    src = sinks.write_ndjson(df, str(tmp_path / "in"))
    out = spark.read.json(jobs.daily_job(spark, src, str(tmp_path / "daily"), "J"))
    assert out.count() == 220 and "feature_engineering_metadata" in out.columns
    vend = sinks.write_vendor_documents(df, str(tmp_path / "vendor"))
    res = jobs.advanced_job(spark, vend, str(tmp_path / "adv"))
    meta = spark.read.json(res["metadata"]).first()
    assert meta["Original_Records"] == 220 and meta["Records_Count"] == 21
    assert spark.read.json(res["summary"]).first()["files_processed"] == 1
    env = sinks.write_envelopes(df, str(tmp_path / "env"))
    expected = spark.createDataFrame([("J",), ("NONE",)], "symbol string")
    ing = jobs.ingestion_job(spark, env, expected, str(tmp_path / "zones"), "s1")
    assert spark.read.json(ing["processed_latest"]).count() == 220
    st = {r["workflow_id"]: r["status"] for r in
          __import__("barsmith.operators.runlog", fromlist=["x"]).workflow_status(
              spark.read.parquet(ing["run_log"])).collect()}
    assert st == {"J": "running", "NONE": "failed"}
