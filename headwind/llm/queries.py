"""The registered queries of this package: each operator over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headwind.llm import (
    filter_audit,
    hard_negatives,
    mixing,
    multiset,
    neardup,
    packing,
    prefix_counts,
    quality,
    rules,
    secrets,
    suffix_tree,
    toxicity,
    urls,
)
from headwind.llm.texts import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group(table(spark, sf_dir, "documents"), size=3, percent=85)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.fingerprints(table(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_suffix_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.count(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def registered() -> dict[str, Query]:
    found = {f.__name__: f for f in globals().values() if getattr(f, "__name__", "")[:2] == "op"}
    return dict(sorted(found.items(), key=lambda f: int(f[0][2:].split("_")[0])))


def statements() -> dict[str, str]:
    return {
        "op7_url_filters": urls.SQL,
        "op12_filter_audit": filter_audit.SQL,
        "op13_hard_negatives": hard_negatives.SQL,
    }
