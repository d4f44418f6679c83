"""A training corpus from the documents table, in stages that each write a table.

A stage takes (spark, docs, sf_dir) and returns the rows that it keeps, with the columns of documents;
the last adds the shard. Each works on all rows that the one before kept. Toxicity and
decontamination judge each row by itself, so clean documents stay; near-dedup keeps the document
with the smallest id of each group; mixing repeats or leaves out rows to meet the sources' targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daytally.llm import decontamination, minhash, mixing, sharding, toxicity
from daytally.llm.common import Store, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_rows(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.kept_rows(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The first stage trains a model, which SQL can't express; the tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    store = Store(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = store.put(stage(spark, docs, sf_dir), name)
        if before:
            store.drop(before)
        before = name
    return docs
