"""The corpus pipeline: each stage calls one training-data operator on all rows its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sidweave.llm import certified_packing, edit_decontam, ftrl_toxicity, secret_novelty, simhash_trie
from sidweave.session import drop, read, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return ftrl_toxicity.clean(docs, read(spark, sf_dir, "labels"), threshold=0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints stays: the one with the smallest id."""
    return simhash_trie.keep_one(docs, words=4, budget=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return edit_decontam.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced, and n_chars follows."""
    return secret_novelty.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces with their places in sequences of 2048 ids."""
    return certified_packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing),
]
ORACLE_SQL: str | None = None  # the stages train, fingerprint and tokenise


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written as Parquet and read back, and goes when the next one is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            drop(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
