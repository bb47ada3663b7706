"""Corpus pipeline over ``documents``: toxicity filter, SimHash near-duplicates,
benchmark decontamination, mixing sources to target weights, sharding.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes each stage's result to the shared scratch folder and reads it
back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import data_dir, scratch_path
from tidemark.llm.common import bounded_batches
from tidemark.llm.decontaminate import keep_clean
from tidemark.llm.mix import mixed_copies
from tidemark.llm.shard import histogram_shards
from tidemark.llm.simhash import keep_one
from tidemark.llm.toxicity import keep_mild


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold. Null and empty
    texts have the score of the intercept and stay; repeated rows get one
    verdict; an empty table, or one without labels, loses nothing."""
    bounded_batches(spark)
    return keep_mild(docs, spark.read.parquet(data_dir(sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies. Null and empty texts are
    copies of each other; of repeated ids one row stays; an empty table stays
    empty."""
    bounded_batches(spark)
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; all rows of an id share
    the verdict. Null and empty texts have no words and stay."""
    bounded_batches(spark)
    return keep_clean(docs, spark.read.parquet(data_dir(sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, one row per copy. A null
    source is one of its own; columns named like the mix's own keep their
    values."""
    return mixed_copies(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with size, checksum, shard and slot; columns of these names
    are replaced. A null text has size 1 and checksum 0; rows that are alike are
    rows of their own."""
    bounded_batches(spark)
    return histogram_shards(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: Scores of a trained model and hash fingerprints are beyond SQL; tests hold
#: each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(data_dir(sf_dir, "documents"))
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
