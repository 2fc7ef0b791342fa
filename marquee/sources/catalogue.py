"""Readers for snapshot logs, repository reports and the snapshot catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Shape of the repository's JSON report.
REPORT_JSON = (
    "array<struct<name:string,backup:array<struct<label:string,type:string,prior:string,"
    "timestamp:struct<start:bigint,stop:bigint>>>>>"
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file and two columns that order the lines of one file.

    A file may be read by several tasks: (block, line_id) follows the file order, as a split starts
    at its block offset and ids grow within a split.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        "value",
    )


LINE_ORDER = ["block", "line_id"]


def labels_from_json(texts: DataFrame, column: str = "value") -> DataFrame:
    """Snapshots named in JSON reports: stanza, label, type, start, stop."""
    stanzas = texts.select(F.explode(F.from_json(column, REPORT_JSON)).alias("s"))
    backups = stanzas.select(F.col("s.name").alias("stanza"), F.explode("s.backup").alias("b"))
    return backups.select(
        "stanza", "b.label", "b.type",
        F.timestamp_seconds("b.timestamp.start").alias("start"),
        F.timestamp_seconds("b.timestamp.stop").alias("stop"),
    )


def read_json_reports(spark: SparkSession, path: str) -> DataFrame:
    """JSON report files, one report each."""
    return labels_from_json(spark.read.text(path, wholetext=True))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue dump of tab-separated (key, field, value) lines."""
    parts = F.split("value", "\t", 3)
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("field"), F.get(parts, F.lit(2)).alias("value")
    )
