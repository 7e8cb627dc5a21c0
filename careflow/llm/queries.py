"""The operators' queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from careflow.llm import (
    chat_formatting,
    decontamination,
    html_extraction,
    language_id,
    license_scan,
    lm_scoring,
    near_dedup,
    packing,
    periodic_runs,
    quality_rules,
    suffix_dedup,
    token_alignment,
    token_counts,
)
from careflow.llm.oracle import ORACLE  # noqa: F401
from careflow.llm.shared import table

BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_RANKS = "byte_bpe_50k.tiktoken"
PIECE_BPE = "piece_bpe_32k.model"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ranks = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(BYTE_BPE_RANKS)
    return packing.pack(table(spark, sf_dir, "documents"), path, ranks, public_tokenizers.PATTERN).drop("ids")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_fp")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.measure(table(spark, sf_dir, "documents"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_formatting.rotate(table(spark, sf_dir, "conversations"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), synthetic=True)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, ranks, b = (public_tokenizers.path(name) for name in (BYTE_BPE, BYTE_BPE_RANKS, PIECE_BPE))
    return token_alignment.align(table(spark, sf_dir, "documents"), a, b, ranks, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_license_scan": op2_license_scan,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_packing": op4_packing,
    "op5_near_dedup": op5_near_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_language_id": op11_language_id,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}
