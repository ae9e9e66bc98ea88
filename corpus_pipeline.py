"""A corpus pipeline: quality rules, near-duplicates, benchmark decontamination, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads; all but the last keep the columns of
``documents``. Nulls, empty and long texts, ties, repeated rows, empty tables and further columns are treated as the
stage's operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chronolith.llm import decontam, near_dup, packing, quality, secret_scan
from chronolith.llm.text import keep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy keeps."""
    return quality.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id. Rows that repeat a doc_id stay or go together."""
    classes = near_dup.near_duplicates(docs)
    gone = keep(classes.where("not kept").select("doc_id").distinct(), "duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts hidden."""
    return secret_scan.redacted(docs)


def harmonic_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("harmonic packing", harmonic_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


#: SQL cannot give token ids; tests hold each stage's operator against brute force.
ORACLE_SQL = None
