"""Training corpus pipeline: quality, near-duplicates, secrets, mixture, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet in
the shared folder and read again as the next stage's ``docs``; all but the last return the
columns of ``documents``.  Rows without an id or text pass the stages as each
operator's docstring says; an empty table gives an empty result.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import mixing, near_dup, packing, quality, secret_scan
from vigil.llm.queries import importable
from vigil.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones among ``docs`` that are not held out."""
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs.select(COLUMNS), quality.train(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on five-word shingles."""
    importable(spark)
    return near_dup.keep_one(docs.select(COLUMNS), threshold=0.8)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind in brackets; ``n_chars`` follows where a text changed."""
    importable(spark)
    before = docs.select(*COLUMNS, F.col("text").alias("__before"))
    changed = F.col("text").isNotNull() & (F.col("text") != F.col("__before"))
    return (secret_scan.redact(before)
            .withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the balanced mixture takes them (0 to 2 times)."""
    importable(spark)
    docs = docs.select(COLUMNS)
    return mixing.apply_mix(docs, mixing.mix(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, with their ids (little-endian unsigned 32-bit) and a checksum."""
    importable(spark)
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Training, component search and rounding can't be written in SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; what lies between them stays in a new folder under ``spark.checkpoint.dir``."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
