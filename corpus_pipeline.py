"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import fold, saved, show_package
from skyloom.llm.exact_dedup import drop_exact_duplicates
from skyloom.llm.language import keep_identified
from skyloom.llm.mixing import take_mix
from skyloom.llm.near_dedup import drop_near_duplicates
from skyloom.llm.packing import pack_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without an identifiable language go."""
    show_package(spark)
    return keep_identified(docs, fold(F.col("doc_id"), 4) != 2)


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    show_package(spark)
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 stays."""
    show_package(spark)
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in the copies that bring the sources to their target weights."""
    show_package(spark)
    return take_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All copies cut and placed in sequences of 2048 tokens."""
    show_package(spark)
    return pack_documents(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"), end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

# Automata, signatures and tokenizers are not stated in SQL; tests compare every stage with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, folder), f"stage-{name}")
    return STAGES[-1][1](spark, docs, folder)
