"""Sharding by a two-pass external shuffle.

First pass: every record is scattered by seeded hashes, to a shard that its id and the number of shards decide and
there to one of the buckets, whose number follows from the bytes of the input so that a bucket fits in a task's
memory. Second pass: each bucket is shuffled by Fisher-Yates with a seed of its own and written. Buckets are
uniform whatever the sources, texts or sizes are, and both passes are pure functions of the rows and the seed, so
a task that is run again gives the same records.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import text_key

BUCKET_BYTES = 32 << 20
LAW = "key"


def shard_of(doc_id: Column, shards: int, seed: int) -> Column:
    """Highest random weight: the shard whose seeded hash with the id is the largest.

    With one more shard, a row either stays or goes to the new shard. Rows without an id are one key.
    """
    weights = [F.struct(F.xxhash64(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(s)).alias("w"),
                        F.lit(s).alias("s")) for s in range(shards)]
    return (F.greatest(*weights) if shards > 1 else weights[0])["s"]


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A permutation of 0..n-1: each place, from the last down, swaps with one at or below it."""
    order = np.arange(n)
    picks = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64)
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return order


def shuffle_into_shards(docs: DataFrame, shards: int = 8, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every row of ``docs``, all columns kept, with ``shard`` and ``slot`` (its place in the shard, from 0).

    Reads ``doc_id`` and ``text``; columns of the input named shard or slot are replaced. Null texts have no
    bytes. Rows that repeat an id and a text get places of their own. One pass over the text lengths sizes
    the buckets; rows move once. An empty table gives an empty result.
    """
    base = docs.drop("shard", "slot")
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    total = base.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // (bucket_bytes * shards)))
    row = F.struct(*[F.col(f"`{c}`") for c in base.columns])
    placed = base.select(
        shard_of(F.col("doc_id"), shards, seed).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_key(F.col("text"))),
               F.lit(buckets)).cast("int").alias("bucket"),
        row.alias("row"),
    )
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("start"))

    def second_pass(key: tuple, table: pa.Table) -> pa.Table:
        shard, bucket = key[0].as_py(), key[1].as_py()
        table = table.combine_chunks()
        # A fixed order first, as rows arrive in any order.
        table = table.take(pc.sort_indices(table, sort_keys=[("order_id", "ascending"), ("order_text", "ascending")]))
        order = fisher_yates(table.num_rows, np.random.default_rng([seed, shard, bucket]))
        table = table.take(pa.array(order))
        slot = pc.add(table["start"], pa.array(np.arange(table.num_rows, dtype=np.int64)))
        return pa.table([table["shard"], slot.cast(pa.int64()), table["row"]], names=["shard", "slot", "row"])

    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType()),
                           T.StructField("row", placed.schema["row"].dataType)])
    dealt = (placed.join(starts, ["shard", "bucket"])
             .withColumns({"order_id": F.col("row.doc_id"), "order_text": text_key(F.col("row.text"))})
             .groupBy("shard", "bucket").applyInArrow(second_pass, schema))
    return dealt.select("row.*", "shard", "slot")


def write_shards(dealt: DataFrame, path: str) -> None:
    """Write what ``shuffle_into_shards`` returns, one folder per shard; files hold ranges of slots in order."""
    dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode(
        "overwrite").parquet(path)
