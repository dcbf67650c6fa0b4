"""Queries of the training-data operators, and their oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, chat, decontaminate, html_main, jaccard_join, language, line_dedup, lm_score,
               merkle, minhash, periodic, quality, warc)
from .common import prepare, table


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return line_dedup.query(table(spark, sf_dir, "documents"))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lm_score.query(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return chat.query(table(spark, sf_dir, "conversations"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return html_main.query(table(spark, sf_dir, "pages"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return warc.query(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language.query(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.query(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.query(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.query(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return periodic.query(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return merkle.query(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_line_dedup": op2_line_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_html_extraction": op4_html_extraction,
    "op5_decontamination": op5_decontamination,
    "op6_warc": op6_warc,
    "op7_language_id": op7_language_id,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_bpe": op9_bpe,
    "op10_quality_rules": op10_quality_rules,
    "op11_minhash": op11_minhash,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE = {
    "op2_line_dedup": line_dedup.QUERY_SQL,
    "op3_chat_formatting": chat.QUERY_SQL,
    "op8_jaccard_join": jaccard_join.QUERY_SQL,
    "op11_minhash": minhash.QUERY_SQL,
    "op12_periodic_runs": periodic.QUERY_SQL,
    "op13_merkle_manifest": merkle.QUERY_SQL,
}
