"""From raw documents to training sequences, in stages that each write what the next one reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, packing, quality, secrets, simhash
from ledgerloom.llm.common import read, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier rejects; it is trained on the labels among the stage's own input."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group whose SimHash fingerprints link: 3-word shingles, 3 bits."""
    return simhash.keep_one(docs).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a benchmark item is found, also with changed numbers, names and units."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark")).select(COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep every document, with a mark in the place of each secret; n_chars counts the new text."""
    out = secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(COLUMNS)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("packing", best_fit),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{scratch(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


#: The stages train a model, tokenize and pack: SQL cannot express them. tests/llm holds run() against brute force.
ORACLE_SQL = None
