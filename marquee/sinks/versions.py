"""Snapshots of a table over time: fulls, differentials and incrementals, with their catalogue.

A full holds the table; a differential the changes since the latest full; an incremental the
changes since the latest snapshot of any kind. Every snapshot has its own folder and counts once
its catalogue entry, written last, exists.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.columns import TYPE_LETTERS
from marquee.operators import snapshots as SN
from marquee.sources.tsv import path_exists, remove_path

CATALOGUE_DDL = "stanza string, label string, type string, ts timestamp, path string"


def catalogue(spark: SparkSession, root: str) -> DataFrame:
    """Entries of all snapshots under ``root`` (one small row each)."""
    if not path_exists(spark, f"{root.rstrip('/')}/catalogue/*/*"):
        return spark.createDataFrame([], CATALOGUE_DDL)
    return spark.read.schema(CATALOGUE_DDL).parquet(f"{root.rstrip('/')}/catalogue/*/*")


def _rebuilt(spark: SparkSession, chain: DataFrame, keys: list[str]) -> DataFrame:
    # A chain is one full and the snapshots behind it: a short list of folders.
    entries = chain.orderBy("ts", "label").select("role", "path").collect()
    full = spark.read.parquet(entries[0]["path"])
    sets = [(i, spark.read.parquet(e["path"])) for i, e in enumerate(entries[1:], start=1)]
    return SN.rebuild(full, sets, keys)


def restore(
    spark: SparkSession, root: str, table: str, keys: list[str], target: datetime | None = None, label: str | None = None
) -> DataFrame:
    """The table as of ``target``, as of a named snapshot, or as of the latest one."""
    entries = catalogue(spark, root).filter(F.col("stanza") == table)
    if label is not None:
        chain = SN.restore_set(entries, label)
    else:
        chain = SN.restore_chain(entries, None if target is None else F.lit(target))
    if chain.isEmpty():
        raise ValueError(f"no snapshot of {table} to restore from")
    return _rebuilt(spark, chain, keys)


def take(
    spark: SparkSession, root: str, table: str, df: DataFrame, keys: list[str], kind: str, ts: datetime
) -> str | None:
    """Take a snapshot; returns its label, or None when nothing changed since its base.

    The first snapshot of a table is a full, whatever was asked for.
    """
    root = root.rstrip("/")
    entries = catalogue(spark, root).filter(F.col("stanza") == table)
    fulls = entries.filter("type = 'full'").agg(F.max(F.struct("ts", "label", "path")).alias("f")).first()["f"]
    kind = "full" if fulls is None else kind
    stamp = ts.strftime("%Y%m%d-%H%M%S")
    label = f"{stamp}F" if kind == "full" else f"{fulls['label']}_{stamp}{TYPE_LETTERS[kind]}"
    path = f"{root}/data/{table}/{label}"
    if kind == "full":
        df.write.mode("errorifexists").parquet(path)
    else:
        base = spark.read.parquet(fulls["path"]) if kind == "diff" else restore(spark, root, table, keys)
        SN.diff(base.select(*df.columns), df, keys).write.mode("errorifexists").parquet(path)
        if not SN.has_changes(spark.read.parquet(path)):
            remove_path(spark, path)  # nothing refers to it, and the same stamp may be taken again
            return None
    entry = spark.createDataFrame([(table, label, kind, ts, path)], CATALOGUE_DDL)
    entry.coalesce(1).write.mode("errorifexists").parquet(f"{root}/catalogue/{table}/{label}")
    return label
