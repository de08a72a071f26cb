"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, html_text, language_id, lexical_search, license_scan, ngram_join, oracles, packing, quality_model, quality_rules, suffix_dedup, token_counts, toxicity, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.op1(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.op2(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op3(table(spark, sf_dir, "documents"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.op4(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.op5(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.op6(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op7(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op8(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op9(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op10(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.op11(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.op12(table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op13(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_html_text": op2_html_text,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_model": op4_quality_model,
    "op5_ngram_join": op5_ngram_join,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_quality_rules": op9_quality_rules,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_lexical_search": op11_lexical_search,
    "op12_whitening": op12_whitening,
    "op13_token_counts": op13_token_counts,
}

ORACLE_SQL: dict[str, str] = {"op5_ngram_join": oracles.OP5, "op8_decontamination": oracles.OP8, "op9_quality_rules": oracles.OP9, "op11_lexical_search": oracles.OP11}
