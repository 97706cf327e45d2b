"""A corpus pipeline of five of the operators: documents in, mixed and sharded documents out.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept.  ``run`` applies them to the
table ``documents``, each stage's result written to the shared checkpoint folder before the next one reads it.
Cases (nulls, empty and long texts, repeated rows, empty tables, further columns): as each operator states them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontamination import decontaminate
from tidemark.llm.frames import checkpointed
from tidemark.llm.mixing import mixture
from tidemark.llm.ngram_join import one_of_each
from tidemark.llm.quality_rules import quality_filter
from tidemark.llm.sharding import shard_names, sharded


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_filter(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the sources' target weights ask for."""
    return mixture(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their slot and shard."""
    return sharded(docs, shard_names())


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontamination),
          ("mixing sources to target weights", mixing), ("sharding", sharding)]

#: SQL can't express the suffix-array and near-duplicate stages at a bearable cost; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
