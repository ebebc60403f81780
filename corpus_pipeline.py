"""The corpus pipeline: each stage reads the documents that the stage before it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headwind.llm import mixing, neardup, packing, rules, secrets
from headwind.llm.texts import table, tokenizer_path
from headwind.session import materialize, noting, remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or that the isolation forest rejects go."""
    return rules.keep(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8)."""
    return neardup.keep(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, stay or go as the mix of sources draws them."""
    return mixing.apply(docs)


def vector_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences, one row per piece."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("vector_packing", vector_packing),
]

#: the stages fit models and call a tokenizer, which SQL does not express
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again, and what the stage before it
    left is deleted then."""
    docs, used = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with noting() as made:
            docs = materialize(stage(spark, docs, sf_dir), name)
        *on_the_way, result = made
        remove(spark, [*used, *on_the_way])
        used = [result]
    return STAGES[-1][1](spark, docs, sf_dir)
