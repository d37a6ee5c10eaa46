"""Registered queries of this subpackage: (spark, sf_dir) to the contract's rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hopscan.llm.oracles import SQL
from hopscan.llm import (
    block_dedup, bpe_chunks, kneser_ney, mixing, near_dedup, periodic_runs, pii, ppm_language, quality_rules, spelling, substring_dedup,
    token_files, topk,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.language_model_scores(table(spark, sf_dir, "documents"))


def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents")).drop("check")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("stratum")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.encode_documents(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), least_percent=85).drop("check")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_language.identify(table(spark, sf_dir, "documents"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_rows(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.collapse(table(spark, sf_dir, "documents"), periodic_runs.planted)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), spelling.planted))


def op13_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_dedup.deduplicate(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": op1_lm_scores,
    "op2_mixture": op2_mixture,
    "op3_pii": op3_pii,
    "op4_quality_rules": op4_quality_rules,
    "op5_bpe": op5_bpe,
    "op6_near_dedup": op6_near_dedup,
    "op7_top_k": op7_top_k,
    "op8_language": op8_language,
    "op9_substrings": op9_substrings,
    "op10_token_files": op10_token_files,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling": op12_spelling,
    "op13_block_dedup": op13_block_dedup,
}
