"""A corpus from ``documents``: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkweave.llm import decontaminate, mixing, neardup, sharding, toxicity
from linkweave.llm.common import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject."""
    return toxicity.clean(docs, toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that with the smallest doc_id."""
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in a uniformly random order over eight shards: the columns of documents, shard and slot."""
    return sharding.sharded(docs, shards=8)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: Linear models and XXH64 fingerprints have no SQL form; tests hold the stages to brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
