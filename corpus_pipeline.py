"""A training-data pipeline over ``documents``: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidefetch.llm import decontamination, near_dedup, packing, repeats, rule_ensemble
from tidefetch.llm.common import fresh_path, table
from tidefetch.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return rule_ensemble.keep_good(docs, table(spark, folder, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least doc_id."""
    return near_dedup.drop_near_duplicates(docs)


def substrings(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages that an earlier document has are cut out. n_chars is kept as it came."""
    return repeats.remove_repeats(docs).select(*docs.columns)


def benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages of benchmark items are cut out."""
    return decontamination.decontaminate(docs, table(spark, folder, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Places of the documents' tokens in sequences of 4096."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("substring dedup", substrings),
    ("benchmark decontamination", benchmarks),
    ("best-fit packing", pack),
]

#: Trees, similarity sampling and a tokenizer are beyond SQL; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
