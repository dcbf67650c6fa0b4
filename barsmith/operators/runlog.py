"""Run log (Q10-Q13): stage statuses per workflow, rollups and the error log.

The run log is an ordinary table ``(workflow_id, stage, status, created_at,
updated_at, errors ARRAY<STRUCT<error, error_type, timestamp, node_name>>)``.
:func:`run_log_from_quality` derives one from a pipeline run (one workflow
per symbol); the rollups work on any table of that shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import (RUN_LOG, STATUS_COMPLETED, STATUS_FAILED, STATUS_PENDING, STATUS_RUNNING)

# Stage names and error types used in derived run logs.
INGESTION = "ingestion"
PREPROCESSING = "preprocessing"
TRAINING = "training"
VALIDATION_ERROR = "validation_error"
COMPLETENESS_ERROR = "completeness_error"
GLOBAL = "global"

ERRORS = RUN_LOG["errors"].dataType.simpleString()


def _error(msg, etype, ts, node):
    return F.struct(F.lit(msg).alias("error") if isinstance(msg, str) else msg.alias("error"),
                    F.lit(etype).alias("error_type"), ts.alias("timestamp"), F.lit(node).alias("node_name"))


def run_log_from_quality(report: DataFrame, completeness: DataFrame, spans: DataFrame,
                         threshold: float = 0.8) -> DataFrame:
    """Derive a run log: one workflow per symbol, three stages.

    ingestion: completed if the quality report passed, else failed;
    preprocessing: pending after a failed ingestion, completed if the
    feature completeness reaches ``threshold``, else failed;
    training: running once preprocessing completed (handed to the trainer),
    else pending. ``spans`` gives each symbol's first and last bar time
    (``first_ts``, ``last_ts``), used as created/updated times.
    """
    r = (report.select("symbol", "validation_passed", "overall_quality")
               .join(completeness.select("symbol", "completeness"), "symbol", "left")
               .join(spans.select("symbol", "first_ts", "last_ts"), "symbol", "left"))
    created = F.coalesce(F.col("first_ts"), F.col("last_ts"))
    updated = F.coalesce(F.col("last_ts"), F.col("first_ts"))
    ing_ok = F.coalesce(F.col("validation_passed"), F.lit(False))
    prep_ok = F.coalesce(F.col("completeness") >= F.lit(threshold), F.lit(False))
    no_errors = F.array().cast(ERRORS)

    def stage(name, status, errors):
        return F.struct(F.lit(name).alias("stage"), status.alias("status"), errors.alias("errors"))

    low_quality = _error(F.concat(F.lit("quality "), F.col("overall_quality")), VALIDATION_ERROR, updated, INGESTION)
    gaps = _error(F.concat(F.lit("completeness "), F.format_number(F.col("completeness"), 4)),
                  COMPLETENESS_ERROR, updated, PREPROCESSING)
    stages = F.array(
        stage(INGESTION, F.when(ing_ok, STATUS_COMPLETED).otherwise(STATUS_FAILED),
              F.when(ing_ok, no_errors).otherwise(F.array(low_quality).cast(ERRORS))),
        stage(PREPROCESSING, F.when(~ing_ok, STATUS_PENDING).when(prep_ok, STATUS_COMPLETED).otherwise(STATUS_FAILED),
              F.when(ing_ok & ~prep_ok, F.array(gaps).cast(ERRORS)).otherwise(no_errors)),
        stage(TRAINING, F.when(ing_ok & prep_ok, STATUS_RUNNING).otherwise(STATUS_PENDING), no_errors))
    # One row a workflow, three out of it: the joined inputs are computed once.
    return r.select(F.col("symbol").alias("workflow_id"), created.alias("created_at"), updated.alias("updated_at"),
                    F.explode(stages).alias("s")).select(
        "workflow_id", "s.stage", "s.status", "created_at", "updated_at", "s.errors")


def fold_events(log: DataFrame, events: DataFrame) -> DataFrame:
    """A run log with later events folded in: one row per workflow and stage.

    ``log`` (one row per workflow and stage, or empty) and ``events`` have the
    run log's columns. A stage takes the status of its latest update (of
    equal times, the one whose name is last), its first creation, and all
    errors once, in time order, so folding the same events again changes
    nothing. A combinable aggregate: only the new events and the folded log are
    read, not the history of events.
    """
    both = log.select(*RUN_LOG.fieldNames()).unionByName(events.select(*RUN_LOG.fieldNames()))
    # Errors are few: only rows that have some are collected into sets (a slow aggregate
    # of objects); the sets join the events as rows of their own, so null keys need no join.
    found = (both.where(F.size("errors") > 0).select("workflow_id", "stage", F.explode("errors").alias("e"))
             .where(F.col("e").isNotNull()).groupBy("workflow_id", "stage")
             .agg(F.sort_array(F.collect_set(F.struct("e.timestamp", "e.error", "e.error_type", "e.node_name")))
                  .alias("found")))
    found = found.select("workflow_id", "stage", F.expr(
        "transform(found, e -> named_struct('error', e.error, 'error_type', e.error_type, "
        "'timestamp', e.timestamp, 'node_name', e.node_name))").cast(ERRORS).alias("errors"))
    changes = both.select("workflow_id", "stage", F.struct("updated_at", "status").alias("change"), "created_at",
                          F.lit(None).cast(ERRORS).alias("errors"))
    rows = changes.unionByName(found, allowMissingColumns=True)
    return (rows.groupBy("workflow_id", "stage")
            .agg(F.max("change").alias("last"), F.min("created_at").alias("created_at"),
                 F.first("errors", ignorenulls=True).alias("errors"))
            .select("workflow_id", "stage", "last.status", "created_at", "last.updated_at",
                    F.coalesce("errors", F.array().cast(ERRORS)).alias("errors")))


def workflow_status(log: DataFrame) -> DataFrame:
    """Q10: training completed -> completed; else any failed -> failed; else
    any running -> running; else pending."""
    st = F.col("status")
    return (log.groupBy("workflow_id")
               .agg(F.max((F.col("stage") == TRAINING) & (st == STATUS_COMPLETED)).alias("_t"),
                    F.max(st == STATUS_FAILED).alias("_f"),
                    F.max(st == STATUS_RUNNING).alias("_r"))
               .select("workflow_id",
                       F.when(F.col("_t"), STATUS_COMPLETED).when(F.col("_f"), STATUS_FAILED)
                        .when(F.col("_r"), STATUS_RUNNING).otherwise(STATUS_PENDING).alias("status")))


def workflow_progress(log: DataFrame) -> DataFrame:
    """Q11: completed stages and elapsed seconds per workflow."""
    return (log.groupBy("workflow_id")
               .agg(F.count_if(F.col("status") == STATUS_COMPLETED).alias("completed_stages"),
                    F.count(F.lit(1)).alias("total_stages"),
                    (F.unix_timestamp(F.max("updated_at")) - F.unix_timestamp(F.min("created_at")))
                    .cast("double").alias("elapsed_seconds")))


def error_log(log: DataFrame) -> DataFrame:
    """Q12: errors grouped by the node that raised them (``global`` if none).

    Unlike the original, an error with an unknown node name is kept under
    that name instead of being lost.
    """
    e = log.select("workflow_id", F.explode("errors").alias("e")).select("workflow_id", "e.*")
    return (e.groupBy(F.coalesce(F.col("node_name"), F.lit(GLOBAL)).alias("node"))
             .agg(F.count(F.lit(1)).alias("error_count"),
                  F.count_distinct("workflow_id").alias("workflows"),
                  F.sort_array(F.collect_set("error_type")).alias("error_types")))
