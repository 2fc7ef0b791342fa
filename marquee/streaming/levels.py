"""Levels of merged batches: a stream's change folders, folded in few sorted runs.

Batches come as ``batch=<id>`` folders. Whenever ``fan_out`` runs of one level lie behind one another in time, they are
folded into one run of the next level, so a table of n batches is read from some ``fan_out * log(n)`` folders, and a
row is rewritten once per level. ``_levels/manifest/v=<n>`` lists the runs that count; the last complete one decides. Its
greatest batch is the high-water mark: a batch at or below it is in a run already, so writing it again changes nothing.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.sources.tsv import list_paths, remove_path

FAN_OUT = 4


@dataclass(frozen=True)
class Run:
    """The batches ``lo`` to ``hi``, folded, in the folder ``path`` under the target."""

    lo: int
    hi: int
    level: int
    path: str


def last_values(stacked: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One row per key: of each column the last non-null value by ``_batch``."""
    picks = [F.max(F.when(F.col(c).isNotNull(), F.struct("_batch", F.col(c).alias("v"))))["v"].alias(c)
             for c in names if c not in keys]
    return stacked.groupBy(*keys).agg(*picks).select(*names)


def _complete(spark: SparkSession, target: str, pattern: str) -> dict[int, str]:
    """Number -> folder of the finished writes (those with the ``_SUCCESS`` marker Spark leaves by default) that match ``pattern``, a path that ends in ``=*``."""
    done = [p[: -len("/_SUCCESS")] for p in list_paths(spark, f"{target}/{pattern}/_SUCCESS")]
    return {int(re.search(r"=(-?\d+)$", p).group(1)): p for p in done}


def manifest(spark: SparkSession, target: str) -> list[Run]:
    """The runs that count, oldest first; a list as long as the levels times their fan-out."""
    versions = _complete(spark, target, "_levels/manifest/v=*")
    if not versions:
        return []
    rows = spark.read.parquet(versions[max(versions)]).collect()
    return sorted((Run(r["lo"], r["hi"], r["level"], r["path"]) for r in rows), key=lambda r: r.lo)


def live_runs(spark: SparkSession, target: str) -> list[Run]:
    """The manifest's runs and, as runs of level 0, the finished batches above its high-water mark, oldest first."""
    target = target.rstrip("/")
    runs = manifest(spark, target)
    mark = max((r.hi for r in runs), default=None)
    batches = sorted(b for b in _complete(spark, target, "batch=*") if mark is None or b > mark)
    return runs + [Run(b, b, 0, f"batch={b}") for b in batches]


def stacked_runs(spark: SparkSession, target: str, runs: list[Run], schema: StructType) -> DataFrame | None:
    """The rows of the runs with ``_batch``; runs do not overlap in time, so the last batch of each orders them."""
    parts = [spark.read.schema(schema).parquet(f"{target.rstrip('/')}/{r.path}").withColumn("_batch", F.lit(r.hi).cast("bigint"))
             for r in runs]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _first_full(runs: list[Run], fan_out: int) -> int | None:
    """Where ``fan_out`` runs of one level lie behind one another, the youngest such place."""
    for i in range(len(runs) - fan_out, -1, -1):
        if len({r.level for r in runs[i:i + fan_out]}) == 1:
            return i
    return None


def compact(spark: SparkSession, target: str, schema: StructType, keys: list[str], fan_out: int = FAN_OUT) -> list[Run]:
    """Fold full levels and record the outcome; returns the runs that count then.

    A run is written under a name of its own and counts with the manifest, which is written last and under the next
    number: a failed attempt leaves a folder nobody reads, and of two at one time one fails.
    """
    target = target.rstrip("/")
    runs = live_runs(spark, target)
    moved = False
    while (at := _first_full(runs, fan_out)) is not None:
        part = runs[at:at + fan_out]
        path = f"_levels/run-{part[0].lo}-{part[-1].hi}-{uuid.uuid4().hex}"
        folded = last_values(stacked_runs(spark, target, part, schema), keys, schema.fieldNames())
        folded.sortWithinPartitions(*keys).write.parquet(f"{target}/{path}")
        runs[at:at + fan_out] = [Run(part[0].lo, part[-1].hi, part[0].level + 1, path)]
        moved = True
    if moved:
        tried = [int(p.rsplit("=", 1)[1]) for p in list_paths(spark, f"{target}/_levels/manifest/v=*")]
        rows = spark.createDataFrame([(r.lo, r.hi, r.level, r.path) for r in runs], "lo long, hi long, level int, path string")
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{target}/_levels/manifest/v={max(tried, default=-1) + 1}")
    return runs


def forget(spark: SparkSession, target: str) -> int:
    """Remove batch and run folders that the manifest has folded away; returns how many. No reader may be at work."""
    target = target.rstrip("/")
    runs = manifest(spark, target)
    if not runs:
        return 0
    kept, mark = {r.path for r in runs}, max(r.hi for r in runs)
    batches = [f"batch={b}" for b in _complete(spark, target, "batch=*") if b <= mark]
    stored = [f"_levels/{p.rsplit('/', 1)[1]}" for p in list_paths(spark, f"{target}/_levels/run-*")]
    gone = [p for p in (*batches, *stored) if p not in kept]
    for path in gone:
        remove_path(spark, f"{target}/{path}")
    return len(gone)
