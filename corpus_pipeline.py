"""A corpus from raw documents: five stages, each written as Parquet and read again by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainloom.llm.compression import keep_good
from chainloom.llm.decontam import decontaminate
from chainloom.llm.forest import Forest, one_of_each
from chainloom.llm.mixture import mixed
from chainloom.llm.shared import run_folder, table
from chainloom.llm.sharding import shard


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the compression bands reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by a similarity of word shingles from 0.8, stays."""
    return one_of_each(docs, Forest(percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time the mix takes a document, whole or in part."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of every row of the mix."""
    return shard(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("sharding", sharding),
]

# zstandard ratios can't be had in SQL; tests/llm/test_pipeline.py holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        path = run_folder(spark, f"stage-{at}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
