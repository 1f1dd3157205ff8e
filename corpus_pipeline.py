"""The corpus pipeline: documents through five stages, each written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnstile.llm.decontaminate import without_passages
from turnstile.llm.mixing import mixture
from turnstile.llm.sharding import shard_documents
from turnstile.llm.simhash import without_near_duplicates
from turnstile.llm.toxicity import without_toxic
from turnstile.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go, as the labels beside the documents teach."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links, by three-word shingles at three bits or fewer, the smallest doc_id stays."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight; a document comes as often as it is taken."""
    return mixture(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard, of near equal bytes, and their place in it; equal texts together."""
    return shard_documents(docs, keep=docs.columns)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]
ORACLE_SQL = None  # neither restored toxicity nor scheduling through a heap is a SQL query


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
