"""From raw documents to packed training sequences, in stages that each read what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellmart.llm.common import stored
from cellmart.llm.exact_dedup import drop_copies
from cellmart.llm.langid import keep_identified
from cellmart.llm.minhash import drop_similar
from cellmart.llm.mixing import mix, training_order
from cellmart.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the corpus has; texts without a letter go."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, Jaccard similarity of 0.8 or more. SimHash fingerprints name
    candidates, MinHash bands those that they set too far apart, whole sets decide."""
    return drop_similar(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return training_order(docs, mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in their sequences."""
    return pack(docs).drop("mark")


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mix", mixed),
    ("packing", packed),
]

# fingerprints, hashes and tokens are not to be had in SQL; the stages are tested against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
