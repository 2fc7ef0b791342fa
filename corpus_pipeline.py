"""From raw documents to shuffled shards: quality, near-duplicates, benchmark passages, source mix, sharding.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontam, mixing, quality, sharding, simhash
from marquee.llm.common import same_row, text_key
from marquee.session import ensure_shared_dir, shared_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs.select(COLUMNS), _table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id, one row of it."""
    return simhash.keep_first(docs.select(COLUMNS), shingle=3, max_bits=2)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return decontam.remove_documents(docs.select(COLUMNS), _table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document that is taken twice is there twice, one that is not taken is gone."""
    return mixing.mixed_documents(docs.select(COLUMNS))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place there."""
    return sharding.shuffle_into_shards(docs.select(COLUMNS), shards=8)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("benchmark", benchmark_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written to the shared folder and read again."""
    ensure_shared_dir(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Learned weights, component search and seeded selection have no SQL form; tests compare with brute force.
ORACLE_SQL = None
