"""A training corpus from raw documents: rules, near-duplicates, repeated passages, benchmark leaks, packing.

Every stage takes null ids, texts, languages and sources, empty and very long texts, repeated rows, an empty table and further
columns of any name, which all but the last stage hand on. What each makes of them its docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from careflow.llm import decontamination, near_dedup, packing, quality_rules, suffix_dedup
from careflow.llm.queries import BYTE_BPE, BYTE_BPE_RANKS
from careflow.llm.shared import kept, table, working_folder
from pyspark.sql import functions as F


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A null or empty text has too few words and goes; repeated rows share their fate."""
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the first by id, null ids last. Null and empty texts are one class; of
    rows that repeat one stays."""
    return near_dedup.deduplicated(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too; n_chars is counted anew. Null texts stay null, rows that
    repeat lose all that is long enough, and a text may be left empty."""
    left = suffix_dedup.without_repeats(docs)
    counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", counted)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands. Null and empty texts hold none; rows that repeat stay or go together."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences. A null or empty text gives its closing token only; rows that repeat are packed each. Of the
    columns only doc_id is carried over."""
    path, ranks = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(BYTE_BPE_RANKS)
    return packing.pack(docs, path, ranks, public_tokenizers.PATTERN).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

#: Token ids and byte cuts are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table that the next one reads."""
    folder = working_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
