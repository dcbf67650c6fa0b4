import datetime as dt

from pyspark.sql import functions as F

from barsmith.operators import clean, quality, runlog
from barsmith.schema import RUN_LOG
from helpers import bars, day, ohlc


def _flat(spark, symbol, n, start=0):
    return ohlc(spark, symbol, [(1.0 + i, 2.0 + i, 0.5 + i, 1.5 + i, 10) for i in range(n)]) \
        .withColumn("date", F.date_add("date", start))


def test_grades_and_no_data(spark):
    good = _flat(spark, "GOOD", 12)
    short = _flat(spark, "SHORT", 5)
    holes = bars(spark, [(i, "HOLE", 1.0, 2.0, 0.5, 1.5, None if i == 3 else 10) for i in range(12)])
    expected = spark.createDataFrame([("GOOD",), ("SHORT",), ("HOLE",), ("MISSING",)], "symbol string")
    rep = {r["symbol"]: r for r in quality.quality_report(good.union(short).union(holes), expected).collect()}
    assert rep["GOOD"]["overall_quality"] == "EXCELLENT" and rep["GOOD"]["validation_passed"]
    # 2 of 3 checks: 0.67 < 0.75, so FAIR and not passed
    assert rep["SHORT"]["overall_quality"] == "FAIR" and rep["SHORT"]["validation_passed"] is False
    assert rep["HOLE"]["required_fields"] is False and rep["HOLE"]["overall_quality"] == "FAIR"
    m = rep["MISSING"]
    assert m["data_exists"] is False and m["overall_quality"] == "POOR"
    assert m["validation_passed"] is None and list(m["issues"]) == ["No valid data found"]
    assert (m["passed_checks"], m["total_checks"]) == (0, 1)


def test_first_row_mode(spark):
    # only a later bar lacks volume: the first-record rule passes, all-rows fails
    df = bars(spark, [(i, "F", 1.0, 2.0, 0.5, 1.5, None if i == 5 else 10) for i in range(12)])
    first = quality.quality_checks(df, mode="first").first()
    full = quality.quality_checks(df, mode="all").first()
    assert first["required_fields"] is True and full["required_fields"] is False


def test_duplicate_dates_flagged(spark):
    df = bars(spark, [(0, "D", 1.0, 1.0, 1.0, 1.0, 1), (0, "D", 1.0, 1.0, 1.0, 1.0, 1)])
    assert quality.quality_checks(df).first()["unique_dates"] is False


def test_gates(spark):
    good = _flat(spark, "GOOD", 12)
    short = _flat(spark, "SHORT", 5)
    all_bars = good.union(short)
    rep = quality.quality_report(all_bars)
    gated = quality.ingestion_gate(all_bars, rep)
    assert {r["symbol"] for r in gated.select("symbol").distinct().collect()} == {"GOOD"}
    feats = spark.createDataFrame([("A", 1.0, 2.0), ("A", None, 2.0), ("B", None, None), ("B", 1.0, None)],
                                  "symbol string, x double, y double")
    comp = {r["symbol"]: r["completeness"] for r in quality.completeness(feats, ["x", "y"]).collect()}
    assert comp == {"A": 0.75, "B": 0.25}
    kept = quality.training_gate(feats, ["x", "y"], 0.5)
    assert {r["symbol"] for r in kept.collect()} == {"A"}
    stats = quality.ingestion_stats(quality.quality_report(all_bars)).first()
    assert stats["symbols_processed"] == 2 and stats["success_rate"] == 0.5


def _log(spark, rows):
    t0 = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(w, s, st, t0, t0 + dt.timedelta(seconds=sec), errs) for w, s, st, sec, errs in rows], RUN_LOG)


def test_workflow_status_rules(spark):
    err = [("boom", "execution_error", dt.datetime(2024, 1, 1), "preprocessing")]
    glob = [("lost", "general", dt.datetime(2024, 1, 1), None)]
    log = _log(spark, [
        ("w1", "ingestion", "failed", 5, []), ("w1", "training", "completed", 50, []),
        ("w2", "ingestion", "completed", 5, []), ("w2", "preprocessing", "failed", 9, err),
        ("w3", "ingestion", "completed", 5, []), ("w3", "preprocessing", "running", 7, glob),
        ("w4", "ingestion", "pending", 1, []),
    ])
    st = {r["workflow_id"]: r["status"] for r in runlog.workflow_status(log).collect()}
    assert st == {"w1": "completed", "w2": "failed", "w3": "running", "w4": "pending"}
    pr = {r["workflow_id"]: r for r in runlog.workflow_progress(log).collect()}
    assert pr["w1"]["completed_stages"] == 1 and pr["w1"]["elapsed_seconds"] == 50
    errs = {r["node"]: r["error_count"] for r in runlog.error_log(log).collect()}
    assert errs == {"preprocessing": 1, "global": 1}


def test_run_log_from_quality(spark):
    good = _flat(spark, "GOOD", 12)
    expected = spark.createDataFrame([("GOOD",), ("MISSING",)], "symbol string")
    rep = quality.quality_report(good, expected)
    comp = spark.createDataFrame([("GOOD", 12, 0.5)], "symbol string, record_count long, completeness double")
    spans = good.groupBy("symbol").agg(F.min("date").cast("timestamp").alias("first_ts"),
                                       F.max("date").cast("timestamp").alias("last_ts"))
    log = runlog.run_log_from_quality(rep, comp, spans, 0.8)
    st = {(r["workflow_id"], r["stage"]): r["status"] for r in log.collect()}
    assert st[("GOOD", "ingestion")] == "completed" and st[("GOOD", "preprocessing")] == "failed"
    assert st[("MISSING", "ingestion")] == "failed" and st[("MISSING", "preprocessing")] == "pending"
    assert {r["workflow_id"]: r["status"] for r in runlog.workflow_status(log).collect()} == \
        {"GOOD": "failed", "MISSING": "failed"}


def test_zscore_outliers_ffill(spark):
    closes = [10.0] * 10 + [10.5, 9.5] * 5 + [100.0] + [10.0] * 3
    df = ohlc(spark, "Z", [(c, c, c, c, 1) for c in closes])
    z = {r["date"]: r["close_z"] for r in clean.zscore(df, "close").collect()}
    assert z[day(18)] is None and z[day(19)] is not None and z[day(20)] > 3
    kept = clean.remove_outliers(df, "close")
    assert kept.count() == len(closes) - 1 and kept.filter("close = 100").count() == 0
    gaps = spark.createDataFrame([(day(i), "G", None if i % 4 else float(i)) for i in range(40)],
                                 "date date, symbol string, v double")
    from barsmith.functions.windows import Layout
    for layout in (Layout(), Layout(chunk_rows=3, bucket_seconds=86400)):
        filled = {r["date"]: r["v"] for r in clean.forward_fill(gaps, ["v"], layout).collect()}
        assert all(filled[day(i)] == float(i - i % 4) for i in range(40))
