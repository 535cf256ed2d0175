"""The training-corpus pipeline: quality, toxicity, near-duplicates, repeated passages, packing.

Each stage reads what its predecessor kept, written as Parquet in the shared folder and read again. What a stage
wrote on its way goes when it ends, its input when the next one has been written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import packing, quality, simhash, substring, toxicity
from sievework.llm.shared import scratch, shared_root
from sievework.operators.store import deleted


def _labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_quality(docs, *_labels(spark, sf_dir))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return toxicity.keep_clean(docs, *_labels(spark, sf_dir))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_representatives(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand earlier in the corpus go from the texts."""
    return substring.drop_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("best-fit packing", packing_stage),
]

#: Trained models decide two of the stages, so no SQL gives run()'s rows; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all `documents`.

    Null and empty texts pass through the stages as each one's rule says, repeated rows and ties too; columns of any
    names come along until the packing; no documents give no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_root(spark)}/sievework/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        if k:
            deleted(spark, f"{root}/{k - 1}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
