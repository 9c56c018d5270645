"""Corpus pipeline: classify, apply quality rules, keep one of each near-duplicate group, redact secrets, pack.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame that ``run`` writes as Parquet and reads back for the next stage. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from medalake.llm import bradley_terry, packing, quality_rules, secrets_scan, simhash
from medalake.llm.common import saved, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bradley_terry.keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(spark, docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(spark, docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets_scan.redact(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rule_filter),
    ("simhash_near_dedup", simhash_dedup),
    ("secret_scan", secret_redaction),
    ("packing", sequence_packing),
]

#: The stages are trained models, recursive decoding and tokenizers, which SQL can't express; the tests compare
#: ``run`` with the operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), spark, f"pipeline-{name}")
    return docs
