"""Data quality (Q1-Q9): per-symbol checks, grade, no-data report and gates.

One aggregation per symbol computes every check; nothing is collected. The
three graded checks are those of the original validator:

* ``sufficient_records``: at least 10 bars;
* ``data_structure``: bars exist;
* ``required_fields``: open, high, low, close, volume present. The original
  looks only at the first record and only at key presence; ``mode="first"``
  reproduces the first-record rule (NULL = absent), ``mode="all"`` (default)
  requires every bar to carry all five values.

Grade = share of passed checks: all -> EXCELLENT, >= .75 GOOD, >= .5 FAIR,
else POOR; a symbol passes when EXCELLENT or GOOD. ``unique_dates`` is
reported as well but does not enter the grade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import bounded_broadcast
from ..plans.tables import written
from ..schema import REQUIRED_FIELDS

# Thresholds, grade names and the no-data issue text.
MIN_RECORDS = 10
GRADE_EXCELLENT = "EXCELLENT"
GRADE_GOOD = "GOOD"
GRADE_FAIR = "FAIR"
GRADE_POOR = "POOR"
PASSING_GRADES = [GRADE_EXCELLENT, GRADE_GOOD]
NO_DATA_ISSUE = "No valid data found"
GOOD_SHARE = 0.75
FAIR_SHARE = 0.5
GRADED_CHECKS = ["sufficient_records", "data_structure", "required_fields"]

# Size bound for broadcasting a per-symbol table (one row per symbol).
SYMBOL_TABLE_ROWS = 1 << 21


def row_counts(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Q1: bars per symbol."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"))


def grade(passed: Column, total: Column) -> Column:
    """Q4: grade from passed / total checks."""
    return (F.when(passed == total, F.lit(GRADE_EXCELLENT))
             .when(passed >= total * F.lit(GOOD_SHARE), F.lit(GRADE_GOOD))
             .when(passed >= total * F.lit(FAIR_SHARE), F.lit(GRADE_FAIR))
             .otherwise(F.lit(GRADE_POOR)))


def quality_checks(bars: DataFrame, mode: str = "all", key: str = "symbol",
                   order: str = "date") -> DataFrame:
    """Q3 + Q4: one row per symbol with the checks, counts and grade."""
    present = [F.col(c).isNotNull() for c in REQUIRED_FIELDS]
    all_present = present[0]
    for p in present[1:]:
        all_present = all_present & p
    if mode == "all":
        fields = F.bool_and(all_present)
    elif mode == "first":
        fields = F.min_by(all_present, F.col(order))
    else:
        raise ValueError(f"unknown mode {mode!r}; use 'all' or 'first'")
    agg = bars.groupBy(key).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct(F.col(order)).alias("_q_dates"),
        F.coalesce(fields, F.lit(False)).alias("required_fields"))
    checks = agg.select(
        key, "record_count",
        F.lit(True).alias("data_exists"),
        (F.col("record_count") >= MIN_RECORDS).alias("sufficient_records"),
        (F.col("record_count") > 0).alias("data_structure"),
        "required_fields",
        (F.col("_q_dates") == F.col("record_count")).alias("unique_dates"))
    passed = sum(F.col(c).cast("int") for c in GRADED_CHECKS)
    total = F.lit(len(GRADED_CHECKS))
    return checks.select(
        "*",
        passed.alias("passed_checks"),
        total.alias("total_checks"),
        grade(passed, total).alias("overall_quality"),
        grade(passed, total).isin(PASSING_GRADES).alias("validation_passed"),
        F.array().cast("array<string>").alias("issues"),
        F.current_timestamp().alias("validation_timestamp"))


def quality_report(bars: DataFrame, expected: DataFrame | None = None, mode: str = "all",
                   key: str = "symbol") -> DataFrame:
    """Q3-Q5: checks per symbol; expected symbols without bars get the no-data row.

    ``expected`` is a one-column table of symbols (e.g. the requested list).
    For those without data: ``data_exists`` false, POOR, the no-data issue
    and no ``validation_passed`` (NULL), like the original report.
    """
    checks = quality_checks(bars, mode=mode, key=key)
    if expected is None:
        return checks
    exp = expected.select(F.col(expected.columns[0]).alias(key)).distinct()
    joined = exp.join(checks, key, "left")
    found = F.col("record_count").isNotNull()
    return joined.select(
        key,
        F.coalesce("record_count", F.lit(0).cast("bigint")).alias("record_count"),
        found.alias("data_exists"),
        F.when(found, F.col("sufficient_records")).alias("sufficient_records"),
        F.when(found, F.col("data_structure")).alias("data_structure"),
        F.when(found, F.col("required_fields")).alias("required_fields"),
        F.when(found, F.col("unique_dates")).alias("unique_dates"),
        # a no-data report has one check (data_exists) and it failed
        F.when(found, F.col("passed_checks")).otherwise(F.lit(0)).alias("passed_checks"),
        F.when(found, F.col("total_checks")).otherwise(F.lit(1)).alias("total_checks"),
        F.when(found, F.col("overall_quality")).otherwise(F.lit(GRADE_POOR)).alias("overall_quality"),
        F.when(found, F.col("validation_passed")).alias("validation_passed"),
        F.when(found, F.col("issues")).otherwise(F.array(F.lit(NO_DATA_ISSUE))).alias("issues"),
        F.current_timestamp().alias("validation_timestamp"))


def ingestion_gate(bars: DataFrame, report: DataFrame, key: str = "symbol") -> DataFrame:
    """Q8: bars of the symbols whose report passed (semi join).

    The report has one row per symbol; it is broadcast only behind a
    row-count check, otherwise Spark shuffles both sides.
    """
    passing = report.filter(F.col("validation_passed") & F.col("data_exists")).select(key)
    return bars.join(bounded_broadcast(passing, SYMBOL_TABLE_ROWS), key, "left_semi")


def completeness(features: DataFrame, columns: list[str], key: str = "symbol") -> DataFrame:
    """Per symbol, share of non-null (and non-NaN) values over ``columns``."""
    cells = sum(F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c)), 1).otherwise(0) for c in columns)
    return (features.groupBy(key)
                    .agg(F.count(F.lit(1)).alias("record_count"),
                         F.sum(cells).alias("_q_filled"))
                    .select(key, "record_count",
                            (F.col("_q_filled") / (F.col("record_count") * F.lit(len(columns))))
                            .alias("completeness")))


def training_gate(features: DataFrame, columns: list[str], threshold: float = 0.8,
                  key: str = "symbol") -> DataFrame:
    """Q9: feature rows of the symbols whose completeness reaches ``threshold``.

    The rows are written first: the gate reads them twice and computes them once.
    """
    features = written(features, "gate")
    ok = completeness(features, columns, key).filter(F.col("completeness") >= threshold).select(key)
    return features.join(bounded_broadcast(ok, SYMBOL_TABLE_ROWS), key, "left_semi")


def ingestion_stats(report: DataFrame, key: str = "symbol") -> DataFrame:
    """Q13: symbols processed and success rate (share of symbols that passed)."""
    return report.agg(
        F.count_distinct(key).alias("symbols_processed"),
        F.avg(F.coalesce(F.col("validation_passed"), F.lit(False)).cast("double")).alias("success_rate"))
