"""The registered queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    decontam, exact_dedup, hard_negatives, licenses, line_dedup, mixing, ngram_join, passages, periodic, quality, sharding,
    simhash, suffix_dedup,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", "n_runs",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_shards(spark: SparkSession, folder: str) -> DataFrame:
    shards, seed = 8, 17
    dealt = sharding.shuffle_into_shards(_table(spark, folder, "documents"), shards, seed)
    text = F.coalesce("text", F.lit(""))
    return dealt.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"), "shard", "slot",
        sharding.shard_of(F.col("doc_id"), shards + 1, seed).alias("grown_shard"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, folder, "documents"))


def op7_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.passage_classes(_table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.dedup_substrings(_table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, folder, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine_hard_negatives(hard_negatives.with_moved_labels(_table(spark, folder, "embeddings")))


def op12_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, folder, "documents"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.with_planted_runs(_table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_mix_sources, op2_quality, op3_line_dedup, op4_shards, op5_decontaminate, op6_exact_dedup, op7_passages,
              op8_substring_dedup, op9_simhash, op10_licenses, op11_hard_negatives, op12_ngram_join, op13_periodic_runs, pipeline)
}
