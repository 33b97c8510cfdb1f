"""One query per operator with its production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentlake.llm import (
    decontaminate,
    filter_audit,
    language_id,
    line_dedup,
    mixing,
    packing,
    quality_rules,
    secret_scan,
    simhash_dedup,
    spelling,
    substring_dedup,
    token_counts,
    token_output,
)
from contentlake.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


def op4_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return quality_rules.judge(table(spark, sf_dir, "documents"), vocabulary)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op8_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_output.corpus_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_line_dedup": op3_line_dedup,
    "op4_tokeniser_fertility": op4_tokeniser_fertility,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_language_id": op7_language_id,
    "op8_token_id_output": op8_token_id_output,
    "op9_secret_scan": op9_secret_scan,
    "op10_source_mix": op10_source_mix,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_filter_audit": op12_filter_audit,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {"op3_line_dedup": line_dedup.ORACLE_SQL, "op12_filter_audit": filter_audit.ORACLE_SQL}
