"""Corpus pipeline: each stage reads what the one before kept and returns documents.

Stages: language identification (documents it rejects go), the n-gram Jaccard join (one document
of each group of near copies stays; five words, similarity 0.8), benchmark decontamination
(documents that hold a benchmark item go), mixing sources to target weights (documents occur as
often as the mix takes them), sharding (each document with its shard).
``run`` writes every stage as Parquet under the shared checkpoint folder and rereads it, so a
lost executor repeats at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import decontaminate, jaccard, language_id, mixing, sharding
from pitwall.llm.common import cut, read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(spark, docs, n=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(spark, docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(spark, docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(spark, docs, keep=True)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

# the stages learn models and hash with functions that SQL lacks
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
