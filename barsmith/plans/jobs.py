"""End-to-end jobs: each reads, computes and writes with one heavy pass.

* :func:`bars_job` -- ticks -> bar table (written, so feature jobs start
  from a materialised, much smaller table).
* :func:`daily_job` -- NDJSON bars -> daily feature set + run columns -> NDJSON.
* :func:`advanced_job` -- vendor documents -> 82 features -> complete rows
  per symbol + metadata + processing summary.
* :func:`ingestion_job` -- envelopes -> quality report -> gate -> raw-zone
  snapshot -> local feature set -> processed-zone snapshot -> run log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import DEFAULT_LAYOUT, Layout
from ..operators import advanced as adv
from ..operators import daily, local, quality, runlog
from ..operators.bars import bars_from_ticks
from ..sources import readers, sinks
from .tables import bar_table


#: Names the job in its metadata records.
PROCESSOR = "advanced_job"


def bars_job(ticks: DataFrame, out: str, period: str = "day", **cols) -> str:
    """B1 as a job: aggregate ticks and write the bar table as Parquet."""
    return sinks.write_parquet(bars_from_ticks(ticks, period=period, **cols), out)


def _quarantine(lines: DataFrame, out: str) -> str:
    """Write malformed input (``out/lines``) and its count per file (``out/counts``)."""
    lines.write.mode("overwrite").json(f"{out}/lines")
    kept = lines.sparkSession.read.schema(lines.schema).json(f"{out}/lines")
    counts = kept.groupBy("path").agg(F.count(F.lit(1)).alias("malformed"))
    counts.write.mode("overwrite").json(f"{out}/counts")
    return out


def daily_job(spark: SparkSession, input_path: str, output_path: str,
              symbol: str | None = None, layout: Layout = DEFAULT_LAYOUT, timed: bool | None = None) -> str:
    """The daily feature job: S1 -> D1-D7 -> P1-P4 -> K1 (one write action).

    Malformed input lines go to ``<output_path>_malformed``, with their counts.
    The input is scanned once. ``timed`` says whether dates hold a time of day;
    unset, they do if any of them does.
    """
    staged = readers.stage_bar_lines(spark, input_path)
    _quarantine(readers.staged_malformed(staged), f"{output_path.rstrip('/')}_malformed")
    bars = bar_table(readers.staged_bars(staged, timed))
    feats = daily.with_run_columns(daily.daily_features(bars, layout), symbol)
    return sinks.write_ndjson(feats, output_path)


def advanced_job(spark: SparkSession, input_dir: str, output_dir: str,
                 layout: Layout = DEFAULT_LAYOUT, timed: bool | None = None,
                 documents: bool = False) -> dict[str, str]:
    """The advanced feature job: S2 -> A1-A28 -> K7 -> K8.

    The documents are scanned once; malformed ones go to ``malformed``, with their
    counts. Rows are Parquet per symbol; ``documents`` also writes them as JSON with
    each symbol's metadata beside. The heavy feature plan runs once (the write of complete rows); the
    metadata is then computed from the input counts and the written rows.
    """
    points, bad = readers.stage_vendor_points(spark, input_dir)
    malformed = _quarantine(bad, f"{output_dir.rstrip('/')}/malformed")
    bars = bar_table(readers.vendor_bars(points, timed=timed))
    feats = adv.advanced_features(bars, layout)
    rows = f"{output_dir.rstrip('/')}/rows"
    sinks.by_symbol(adv.complete_rows(feats)).write.mode("overwrite").partitionBy("symbol").parquet(rows)
    # The known schema: symbols such as 0700 stay text, and no complete row at all is an empty table.
    kept = spark.read.schema(feats.schema).parquet(rows).groupBy("symbol").agg(F.count(F.lit(1)).alias("Records_Count"))
    original = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("Original_Records"))
    names = [adv.REFERENCE_NAMES.get(c, c) for c in adv.BASE_COLUMNS + adv.ADVANCED_FEATURES]
    meta = (original.join(kept, "symbol", "left")
            .select(F.col("symbol").alias("Symbol"),
                    F.lit("advanced_features").alias("Processing_Type"),
                    F.array(*[F.lit(n) for n in names]).alias("Features_Created"),
                    F.coalesce("Records_Count", F.lit(0).cast("bigint")).alias("Records_Count"),
                    "Original_Records",
                    F.lit(adv.FEATURES_COUNT).alias("Features_Count"),
                    F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("Processing_Date"),
                    F.lit(PROCESSOR).alias("processor")))
    meta_path = f"{output_dir.rstrip('/')}/metadata"
    meta.write.mode("overwrite").json(meta_path)
    if documents:
        sinks.write_symbol_documents(spark.read.schema(feats.schema).parquet(rows),
                                     spark.read.schema(meta.schema).json(meta_path), f"{output_dir.rstrip('/')}/documents")
    summary, outputs = sinks.processing_summary(spark.read.schema(meta.schema).json(meta_path), output_dir)
    summary.write.mode("overwrite").json(f"{output_dir.rstrip('/')}/summary")
    outputs.write.mode("overwrite").json(f"{output_dir.rstrip('/')}/outputs")
    return {"rows": rows, "metadata": meta_path, "malformed": malformed, "documents": f"{output_dir.rstrip('/')}/documents",
            "summary": f"{output_dir.rstrip('/')}/summary", "outputs": f"{output_dir.rstrip('/')}/outputs"}


def ingestion_job(spark: SparkSession, envelope_path: str, expected: DataFrame, base: str,
                  snapshot: str, timeframe: str = "daily",
                  layout: Layout = DEFAULT_LAYOUT, timed: bool | None = None) -> dict[str, str]:
    """Ingestion + local preprocessing for a set of requested symbols.

    The envelopes are scanned once, in either form; the report, the gate and the
    quarantine read what that scan wrote. The quality report (one row per symbol) is written first and read back,
    so the gate and the run log use one materialised copy. Later steps read
    back only this run's snapshot (partition-pruned, known schema), never the
    whole zone, so the work follows the size of the run, not of the history.
    """
    root = base.rstrip("/")
    staged = readers.stage_envelopes(spark, envelope_path)
    malformed = _quarantine(readers.staged_malformed(staged), f"{root}/malformed/snapshot={snapshot}")
    bars = bar_table(readers.staged_envelope_bars(staged, timed=timed))
    report_path = f"{root}/reports/snapshot={snapshot}"
    quality.quality_report(bars, expected).write.mode("overwrite").parquet(report_path)
    report = spark.read.parquet(report_path)
    gated = quality.ingestion_gate(bars, report)
    raw = sinks.write_snapshot(gated, root, snapshot, timeframe, sinks.RAW_ZONE)
    stored = readers.as_bars(sinks.read_snapshot(spark, raw["history"], gated.schema, snapshot, timeframe))
    feats = local.local_features(stored, layout)
    processed = sinks.write_snapshot(feats, root, snapshot, timeframe, sinks.PROCESSED_ZONE)
    comp = quality.completeness(sinks.read_snapshot(spark, processed["history"], feats.schema, snapshot, timeframe),
                                local.LOCAL_FEATURES)
    spans = stored.groupBy("symbol").agg(F.min("date").cast("timestamp").alias("first_ts"),
                                         F.max("date").cast("timestamp").alias("last_ts"))
    log_path = f"{root}/run_log/snapshot={snapshot}"
    runlog.run_log_from_quality(report, comp, spans).write.mode("overwrite").parquet(log_path)
    return {"report": report_path, "raw_latest": raw["latest"], "processed_latest": processed["latest"],
            "run_log": log_path, "malformed": malformed}
