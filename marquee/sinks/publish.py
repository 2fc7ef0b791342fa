"""All-or-nothing publishing of a set of tables.

Every run writes into its own folder. The run counts only once its manifest, written last, exists;
readers follow the newest manifest. A lost executor, a failed table or a failed check leaves the
previous run in place, and no job ever overwrites a folder it reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee.sources.tsv import path_exists

MANIFEST_DDL = "seq bigint, run string, table string, path string, rows bigint"


class RejectedRun(ValueError):
    """A run whose tables break the checks; nothing was published."""


def _next_seq(spark: SparkSession, root: str) -> int:
    if not path_exists(spark, f"{root}/manifests/seq=*"):
        return 1
    return spark.read.schema(MANIFEST_DDL).parquet(f"{root}/manifests").agg(F.max("seq")).first()[0] + 1


Tables = dict[str, DataFrame]
Store = Callable[[str, DataFrame], DataFrame]
Save = Callable[..., None]


def publish(
    spark: SparkSession, root: str, build: Tables | Callable[[Store], Tables],
    check: Callable[[Tables], DataFrame] | None = None,
    write: Callable[[DataFrame, str, Save], None] | None = None,
) -> dict[str, int]:
    """Write tables under a new run, check what was written, then publish the run.

    ``build`` is either the tables or a function building them with ``store`` (name, frame ->
    written table), for tables that read earlier ones. ``check`` gets the written tables and returns
    violations; any row rejects the run. ``write`` (frame, table, save) may lay a table out its own
    way and hands the result (and folder columns, if any) to ``save``. Returns rows per table.
    """
    root = root.rstrip("/")
    seq, run = _next_seq(spark, root), uuid.uuid4().hex
    written: Tables = {}
    paths: dict[str, str] = {}
    rows: dict[str, int] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{root}/runs/{run}/{name}"
        # The rows of each step are counted as they are written: behind any exchange of the layout.
        seen = Observation(f"{name}-{run}")

        def save(laid: DataFrame, by: tuple[str, ...] = ()) -> None:
            laid.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").partitionBy(*by).parquet(paths[name])

        save(df) if write is None else write(df, name, save)
        rows[name] = seen.get["rows"]
        written[name] = spark.read.schema(df.schema).parquet(paths[name])
        return written[name]

    if callable(build):
        build(store)
    else:
        for name, df in build.items():
            store(name, df)
    if check is not None:
        bad = check(written).limit(20).collect()
        if bad:
            raise RejectedRun(f"run {run} not published: {[tuple(r) for r in bad]}")
    entries = [(seq, run, n, paths[n], rows[n]) for n in written]
    # The folder name holds the sequence, so two runs racing for one number cannot both succeed.
    spark.createDataFrame(entries, MANIFEST_DDL).drop("seq").coalesce(1).write.mode("errorifexists").parquet(
        f"{root}/manifests/seq={seq}"
    )
    return rows


def current(spark: SparkSession, root: str, seq: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest published run, or of run number ``seq``."""
    root = root.rstrip("/")
    manifest = spark.read.schema(MANIFEST_DDL).parquet(f"{root}/manifests")
    if seq is None:
        seq = manifest.agg(F.max("seq")).first()[0]
    entries = manifest.filter(F.col("seq") == seq).select("table", "path").collect()
    return {r["table"]: spark.read.parquet(r["path"]) for r in entries}


def history(spark: SparkSession, root: str) -> DataFrame:
    """Every published run with its tables and row counts."""
    return spark.read.schema(MANIFEST_DDL).parquet(f"{root.rstrip('/')}/manifests").orderBy("seq", "table")
