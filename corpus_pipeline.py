"""The corpus pipeline: five stages over ``documents``, each a written table.

Quality rules drop what they reject; line dedup drops repeated lines; the
Jaccard join leaves one row of each group of near duplicates (the smallest
doc_id); decontamination drops rows that hold a benchmark item; BPE encodes what
is left. A stage works on all its predecessor kept. Both of these stages judge
every row by an id of its own, so null and repeated doc_ids are rows like others.

Extra columns of ``documents`` are dropped at the start. Null texts fail the
quality rules. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import bpe, decontaminate, jaccard_join, line_dedup, quality
from barsmith.llm.common import prepare, stored, table

#: The id of a row inside a stage.
ROW = "row_id"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*[c if c in docs.columns else F.lit(None).cast("string").alias(c) for c in COLUMNS])


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a unique id of the row, written once so that it never changes."""
    return stored(_documents(docs).withColumn(ROW, F.monotonically_increasing_id()), f"pipeline-{name}-rows")


def _by_row(rows: DataFrame) -> DataFrame:
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose verdict is ``kept``; verdicts are joined back by (doc_id, text hash)."""
    prepare(spark)
    docs = _documents(docs)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; ``n_chars`` follows the text. None is dropped."""
    prepare(spark)
    kept = line_dedup.dedup_lines(_documents(docs))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: the smallest doc_id, a null one last."""
    prepare(spark)
    rows = _numbered(docs, "near-duplicates")
    groups = jaccard_join.jaccard_components(_by_row(rows)).select(F.col("doc_id").alias(ROW), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW)).alias("first")
    kept = (rows.select(ROW, "doc_id").join(groups, ROW).groupBy("component_id").agg(first)
            .select(F.col(f"first.{ROW}").alias(ROW)))
    return rows.join(kept, ROW, "left_semi").select(COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    prepare(spark)
    rows = _numbered(docs, "decontamination")
    leaks = decontaminate.find_leaks(_by_row(rows), table(spark, sf_dir, "benchmark"))
    return rows.join(leaks.select(F.col("doc_id").alias(ROW)).distinct(), ROW, "left_anti").select(COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token count and token ids of every document."""
    prepare(spark)
    coded = bpe.encode(_documents(docs), bpe.default_vocabulary())
    return coded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("bpe", encoding_stage),
]

#: SQL can't express the fitted rules, the alignment or the encoding: the tests
#: hold every stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
