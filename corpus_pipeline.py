"""Cleaning of the documents table in five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm import decontaminate, exact, pack, quality, simhash
from cohortwise.session import materialize


def drop_poor_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``quality.THRESHOLD``, learned from those of them that have labels."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.drop_poor(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one that names the group."""
    return simhash.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their places in sequences of 2048."""
    return pack.pack_documents(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", drop_poor_quality),
    ("exact copies", drop_exact_copies),
    ("near copies", drop_near_copies),
    ("benchmark leaks", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# Trained and hashed stages have no SQL; tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
