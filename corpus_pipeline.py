"""The corpus pipeline: raw documents to a mixed, sharded training corpus.

Every stage takes the documents that the stage before it wrote and returns
documents; only the last adds columns (shard, slot). Results for nulls, empty and
very long texts, ties and repeated rows are those of the operators; other columns
pass through, but ``shard`` and ``slot`` are replaced by the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm import decontam, mixing, near_dedup, quality, sharding
from stratamart.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose quality score is below the threshold."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score(model, F.col("text")) >= quality.THRESHOLD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least doc_id of each near-duplicate class."""
    return near_dedup.keep_one(docs)


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, the shard of each document and its place in the shard.

    Columns ``shard`` and ``slot`` of the documents give way to those of the stage.
    """
    placed = sharding.shard(docs.drop("shard", "slot"))
    return placed.withColumnsRenamed({sharding.SHARD: "shard", sharding.SLOT: "slot"})


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontam", decontam_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The classifier has no form in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
