"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to the whole of its table."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (ann, conversation_repair, divergence, fingerprint, html_text, mixing, near_dup, ngram_join, packing, preferences, quality,
                       secret_scan, token_counts)


def importable(spark: SparkSession) -> None:
    """Local sessions started from another folder: Python workers get this
    package's folder on their path (clusters get the package by --py-files)."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (here, env.get("PYTHONPATH", "")) if p)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (packing.pack(_table(spark, sf_dir, "documents"))
            .select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.per_document(mixing.mix(_table(spark, sf_dir, "documents")))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans, base = F.col("spans"), [r.kind for r in secret_scan.BASE_RULES]
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return secret_scan.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", *map(count, base),
        F.sha2(secret_scan.joined(F.filter(spans, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        secret_scan.joined(spans).alias("spans"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.format_pairs(preferences.contrast_pairs(_table(spark, sf_dir, "conversations")))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_packing, op3_fingerprints, op4_mixing, op5_nearest_neighbours, op6_secret_scan, op7_html_text, op8_token_counts, op9_near_duplicates, op10_preference_format,
                                   op11_source_divergence, op12_ngram_join, op13_conversation_repair)}


def queries():
    return dict(QUERIES)
