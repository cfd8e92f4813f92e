"""The thin queries of this package: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import (
    bpe,
    decontam,
    hard_negatives,
    hmm_lm,
    html_main,
    language_id,
    pii,
    quality_qda,
    quality_rules,
    simhash,
    spelling_variants,
    token_count,
    warc,
)
from feedlake.llm.common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_hidden_markov_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.text_scores(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rule_report(table(spark, sf_dir, "documents"))


def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_hidden_markov_lm,
        op3_benchmark_decontamination,
        op4_byte_level_bpe,
        op5_personal_data,
        op6_main_text,
        op7_token_counts,
        op8_quality_rules,
        op9_simhash_near_duplicates,
        op10_warc_archives,
        op11_hard_negatives,
        op12_spelling_variants,
        op13_language_id,
    )
}
