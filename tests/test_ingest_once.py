"""Raw text read once, whatever its form; writers by symbol; folded run logs; late ticks."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from barsmith.operators import runlog
from barsmith.operators.bars import bars_from_ticks
from barsmith.plans import jobs
from barsmith.schema import RUN_LOG
from barsmith.sources import readers, sinks
from barsmith.streaming.bars_stream import tick_stream
from barsmith.streaming import corrections as late
from helpers import day, ohlc


def vendor(symbol, days, **meta):
    series = {f"2024-{1 + d // 28:02d}-{1 + d % 28:02d}": {"1. open": "1.5", "2. high": "2", "3. low": "1", "4. close": str(d),
                                                       "5. volume": "10"} for d in range(days)}
    return {"Meta Data": {"1. Information": "prices", "2. Symbol": symbol, **meta}, "Time Series (Daily)": series}


@pytest.mark.parametrize("indent", [None, 4])
def test_vendor_documents_are_split_into_days(spark, tmp_path, indent):
    good = json.dumps(vendor("AA", 200), indent=indent)
    swapped = vendor("BB", 3)
    swapped = {"Time Series (Daily)": swapped["Time Series (Daily)"], "Other": {"2024-01-09": {"1. open": "9"}},
               "Meta Data": swapped["Meta Data"]}
    files = {"a": good, "b": json.dumps(swapped, indent=indent), "broken": "{broken", "cut": good[:-2], "cutline": good[:-1] + "\n",
             "trail": good.replace("AA", "DD") + "\n\n", "text": "no json at all", "empty": json.dumps(
                 {"Meta Data": {"2. Symbol": "E"}, "Time Series (Daily)": {}, "Later": {"2024-01-01": {"1. open": "1"}}}),
             "brace": json.dumps(vendor("CC", 2, note="a } in text"))}
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # a document is read by several tasks
    try:
        points, bad = readers.stage_vendor_points(spark, str(tmp_path))
        bars = readers.vendor_bars(points)
        counts = {r["symbol"]: r["n"] for r in bars.groupBy("symbol").agg(F.count_distinct("date").alias("n")).collect()}
        assert counts == {"AA": 200, "BB": 3, "DD": 200}
        assert bars.agg(F.sum("close")).first()[0] == 2 * sum(range(200)) + 3
        wrong = {os.path.basename(r["path"])[:-5] for r in bad.collect()}
        assert wrong == {"broken", "cut", "cutline", "text", "brace"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_advanced_job_counts_malformed_documents(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(json.dumps(vendor("AA", 210)))
    (src / "b.json").write_text("{broken")
    out = jobs.advanced_job(spark, str(src), str(tmp_path / "out"), documents=True)
    assert [r["malformed"] for r in spark.read.json(out["malformed"] + "/counts").collect()] == [1]
    rows = spark.read.json(out["documents"] + "/Processed_Data")
    meta = spark.read.json(out["documents"] + "/Meta_Data").collect()
    assert rows.count() == 11 and [(r["symbol"], r["Records_Count"], r["Original_Records"]) for r in meta] == [("AA", 11, 210)]


def test_raw_input_is_scanned_once_by_jobs(spark, tmp_path, monkeypatch):
    lines = sinks.write_envelopes(ohlc(spark, "J", [(1.0, 2.0, 0.5, 1.5, 10)] * 40), str(tmp_path / "env"))
    reads = []
    reader = type(spark.read)
    for name in ("text", "json"):
        real = getattr(reader, name)

        def counted(self, path, *a, _real=real, **k):
            reads.append(str(path))
            return _real(self, path, *a, **k)
        monkeypatch.setattr(reader, name, counted)
    expected = spark.createDataFrame([("J",)], "symbol string")
    jobs.ingestion_job(spark, lines, expected, str(tmp_path / "zones"), "s1")
    assert reads.count(lines) == 1


def test_envelope_forms_side_by_side(spark, tmp_path):
    def envelope(symbol, n):
        return {"success": True, "symbol": symbol, "data": [{"date": f"2024-01-{d + 1:02d}", "close": 1.0} for d in range(n)]}
    (tmp_path / "doc.json").write_text(json.dumps(envelope("D", 3), indent=2))
    (tmp_path / "lines.json").write_text("\n".join([json.dumps(envelope("L", 2)), "oops {", json.dumps(envelope("M", 1)), ""]))
    (tmp_path / "bad.json").write_text('{"success": true,\n "symbol"')
    staged = readers.stage_envelopes(spark, str(tmp_path))
    got = {r["symbol"]: r["n"] for r in readers.staged_envelope_bars(staged).groupBy("symbol").agg(F.count("*").alias("n")).collect()}
    assert got == {"D": 3, "L": 2, "M": 1}
    bad = {os.path.basename(r["path"]): r["value"] for r in readers.staged_malformed(staged).collect()}
    assert bad == {"lines.json": "oops {", "bad.json": '{"success": true,\n "symbol"'}


def test_files_of_a_symbol_follow_its_bytes(spark, tmp_path):
    many = spark.range(0, 4000, 1, 16).select(
        F.date_add(F.lit(day(0)), (F.col("id") / 10).cast("int")).alias("date"), (F.col("id") % 10).cast("string").alias("symbol"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")], F.lit(1).cast("bigint").alias("volume"))
    paths = sinks.write_snapshot(many, str(tmp_path / "z"), "s1")
    for path in paths.values():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
        most = files.groupBy(F.regexp_extract("path", "symbol=([^/]*)", 1)).count().agg(F.max("count")).first()[0]
        assert most <= 2  # 16 tasks each hold all symbols


def test_folding_events_is_incremental_and_idempotent(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(5)]
    err = [("boom", "execution_error", t[1], "training")]
    first = spark.createDataFrame([("w", "training", "running", t[0], t[0], []), ("w", "ingestion", "completed", t[0], t[0], [])], RUN_LOG)
    more = spark.createDataFrame([("w", "training", "failed", t[1], t[1], err), ("w", "training", "pending", t[0], t[0], []),
                                  ("v", "training", "completed", t[2], t[3], [])], RUN_LOG)
    log = runlog.fold_events(runlog.fold_events(first.limit(0), first), more)
    want = {("w", "training"): ("failed", t[0], t[1], 1), ("w", "ingestion"): ("completed", t[0], t[0], 0),
            ("v", "training"): ("completed", t[2], t[3], 0)}

    def rows(df):
        return {(r["workflow_id"], r["stage"]): (r["status"], r["created_at"], r["updated_at"], len(r["errors"])) for r in df.collect()}
    assert rows(log) == want == rows(runlog.fold_events(log, more)) == rows(runlog.fold_events(log.limit(0), first.union(more)))
    assert {r["workflow_id"]: r["status"] for r in runlog.workflow_status(log).collect()} == {"w": "failed", "v": "completed"}


def test_folding_collects_sets_of_events_with_errors_only(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(5)]
    first, later = ("boom", "execution_error", t[1], "training"), ("bang", "execution_error", t[2], None)
    events = spark.createDataFrame([
        ("w", "training", "failed", t[0], t[1], [later, first]), ("w", "training", "running", t[0], t[2], [first, None]),
        (None, "training", "failed", t[1], t[3], [first]), (None, "training", "completed", t[0], t[3], None),
        ("v", None, "pending", t[4], None, []), ("v", None, None, t[0], None, None)], RUN_LOG)
    folded = runlog.fold_events(events.limit(0), events)
    got = {(r["workflow_id"], r["stage"]): (r["status"], r["created_at"], r["updated_at"], [tuple(e) for e in r["errors"]])
           for r in folded.collect()}
    assert got == {("w", "training"): ("running", t[0], t[2], [first, later]),
                   (None, "training"): ("failed", t[0], t[3], [first]), ("v", None): ("pending", t[0], None, [])}
    # The sets are aggregated below a filter on errors, not together with every event.
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("collect_set"):]
    assert "size(errors" in below and plan.count("collect_set") == 1
    assert not any("collect_set" in x and "max(" in x for x in plan.splitlines())


def test_late_ticks_are_kept_counted_and_correct_their_bars(spark, tmp_path):
    src, out, table = (str(tmp_path / x) for x in ("ticks", "out", "table"))
    start = dt.datetime(2024, 1, 1)
    ticks = [(i, "A" if i % 3 else "B", start + dt.timedelta(minutes=7 * i), float((i * 37) % 101)) for i in range(600)]
    ticks[5] = (5, "A", ticks[5][2], float("nan"))
    schema = "tick long, sym string, ts timestamp, price double"
    held_back = {i for i in range(600) if i % 50 == 7}
    batches = [[x for x in ticks[:300] if x[0] not in held_back], [x for x in ticks[300:] if x[0] not in held_back],
               [x for x in ticks if x[0] in held_back]]

    def run():
        stream = tick_stream(spark, src, spark.createDataFrame([], schema).schema, max_files=1).withColumn("one", F.lit(1))
        late.start_corrected_bars(stream, out, "sym", "ts", "price", "one", "tick", "hour", "30 minutes",
                                  str(tmp_path / "ckpt"), available_now=True).awaitTermination(200)
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        run()
    run()  # nothing new
    everything = bars_from_ticks(spark.createDataFrame(ticks, schema), "sym", "ts", "price", F.lit(1), "tick", "hour")

    def rows(df):
        return sorted(map(tuple, df.select("date", "symbol", "open", "high", "low", "close", "volume").collect()), key=str)
    assert rows(late.corrected_bars(spark, out)) == rows(everything)
    counts = late.tick_counts(spark, out).agg(F.sum("ticks"), F.sum("late_ticks")).first()
    kept = late.late_ticks(spark, out)
    assert tuple(counts) == (600, kept.count()) and 0 < kept.count() <= len(held_back)
    assert {r["tick"] for r in kept.collect()} <= held_back
    published = late.published_bars(spark, out)
    assert rows(published) != rows(everything)
    published.withColumn("day", F.to_date("date")).write.partitionBy("day").parquet(table)
    for _ in range(2):
        late.merge_corrections(spark, out, table)
        assert rows(spark.read.parquet(table)) == rows(everything)
    touched = {(r["date"], r["symbol"]) for r in late.corrections(spark, out).collect()}
    assert touched == {(x[2].replace(minute=0), x[1]) for x in ticks if x[0] in {r["tick"] for r in kept.collect()}}


def test_unknown_period_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        late.start_corrected_bars(spark.readStream.schema("a long").parquet(str(tmp_path)), str(tmp_path), "a", "a", "a", "a", "a", "week")
