"""The pipeline from documents to shards; each stage calls one operator on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.llm import decontaminate, mixing, sharding, simhash, toxicity
from tweetflow.llm.common import read
from tweetflow.session import shared_dir

SHARDS = 16


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the labels of the rest teach the model."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that fingerprints of three-word shingles within three bits link, the first stays."""
    return simhash.one_per_group(docs, shingle=3, budget=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item, or a whole shorter one, go."""
    return decontaminate.without_hits(docs, read(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with the shard and the place in it."""
    placed = sharding.assign(docs, SHARDS)
    return placed.select("row.*", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("shard", shard),
]

# Classifier, hashes and suffix arrays have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
