"""A training corpus from the table ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.
Stages but the last return the columns of ``docs``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from closetops.llm import classifier, decontaminate, mixing, sharding, simhash
from closetops.operators import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return classifier.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it, in training order."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contiguous shards of equal bytes; repeats of a document are rows of their own."""
    return sharding.sharded(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixture", mixture), ("shards", shards)]

#: Two stages (classifier, SimHash) are beyond SQL; the tests run the stages after the classifier on a table of edge rows
#: whose results are known by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))  # Parquet, written and reread
    return STAGES[-1][1](spark, docs, sf_dir)
