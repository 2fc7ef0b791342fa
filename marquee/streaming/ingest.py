"""Bounded streaming load: files arriving in a folder, upserted chunk by chunk.

Rewriting the whole table for every chunk would cost the table size per chunk. Here a chunk is
collapsed to one row per key and kept under its batch number; full levels of batches are folded into runs
(see ``levels``), and ``fold`` merges runs, later batches and the base in one aggregation. Writing a batch again
replaces the same folder or one that is in a run already, so a replayed batch changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.operators.upsert import collapse_last_non_null
from marquee.streaming import levels


def put_batch(rows: DataFrame, batch_id: int, target: str, keys: list[str], order: list[str], fan_out: int = levels.FAN_OUT) -> None:
    """Write one batch, one row per key, and fold the levels it fills."""
    target = target.rstrip("/")
    placed = collapse_last_non_null(rows.dropna(subset=keys), keys, order)
    placed.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
    levels.compact(rows.sparkSession, target, rows.schema, keys, fan_out)


def start_ingest(
    stream: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str],
):
    """Start an available-now run writing one collapsed change folder per batch."""
    target = target.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        put_batch(batch, batch_id, target, keys, order)

    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", files_per_batch: int = 1000, **options
) -> DataFrame:
    """A folder as a stream of at most ``files_per_batch`` files per batch."""
    return (
        spark.readStream.schema(schema).format(fmt).options(**options)
        .option("maxFilesPerTrigger", files_per_batch).load(folder)
    )


def fold(spark: SparkSession, target: str, schema: StructType, keys: list[str], base: DataFrame | None = None) -> DataFrame:
    """Base and all batches as one table: per column the last non-null value, later batches first."""
    names = schema.fieldNames()
    parts = [levels.stacked_runs(spark, target, levels.live_runs(spark, target), schema)]
    if base is not None:
        parts.append(base.select(*names).withColumn("_batch", F.lit(-1).cast("bigint")))
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], schema)
    return levels.last_values(reduce(DataFrame.unionByName, parts), keys, names)


def ingest(
    spark: SparkSession, stream: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str],
    base: DataFrame | None = None,
) -> DataFrame:
    """Load everything available now and return the folded table."""
    query = start_ingest(stream, target, checkpoint, keys, order)
    query.awaitTermination()
    return fold(spark, target, stream.schema, keys, base)
