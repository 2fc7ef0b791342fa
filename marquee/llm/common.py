"""Text expressions, row keys and linking shared by the corpus operators."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import ensure_shared_dir

# What separates words, in the two word definitions the operators use.
SPACE_CLASS = r"[\x20\x09-\x0D]"
NOT_SPACE_CLASS = r"[^\x20\x09-\x0D]"
NOT_ALNUM_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is (``lower`` would also change É)."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def alnum_words(text: Column) -> Column:
    """Array of the words (digits, a-z and all beyond ASCII) of the lower-cased text; null text has none."""
    pieces = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_ALNUM_CLASS + "+")
    return F.filter(pieces, lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def same_text(left: Column, right: Column) -> Column:
    """Equality in a form that no join takes for a key: it is computed for the rows whose hashes met, not for all."""
    return (left >= right) & (left <= right)


def text_key(text: Column) -> Column:
    """64-bit key of a text; with the document id it names a row where ids repeat or are null."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.isnull(text))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on (doc_id, text_key), null ids included."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the cluster's shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(ensure_shared_dir(spark))
    return df.checkpoint(eager=True)


def dealt_anew(df: DataFrame, column: str) -> DataFrame:
    """The rows of an aggregate with its grouping column as a new value, so that a join on it shuffles again.

    The engine splits a hot key of a join only if both sides come straight from the join's own exchanges; an
    aggregate that hands over its partitioning stands in the way. What is shuffled again is one row per key.
    """
    return df.withColumn(column, F.col(column).bitwiseXOR(F.lit(0).cast("long")))


def smallest_reachable(spark: SparkSession, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from every node of ``links`` (a, b), as (node, root).

    Large-star and small-star rounds: each round hooks a node's neighbours onto the smallest of them, and the
    links that result are written to the shared folder. Rounds grow with the logarithm of the longest chain.
    Hubs do not gather: the minimum of a node's neighbours combines before the shuffle, and joins on a hub are
    ordinary joins that the engine splits. Nodes without links are not in the result.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges)
    for _ in range(max_rounds):
        # Done when every node hangs on one other, which hangs on none.
        roles = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = roles.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 or (up = 1 and down = 1)").isEmpty():
            break
        # Large star: neighbours above a node move to the smallest of the node and its neighbours.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(dealt_anew(low, "a"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(dealt_anew(least, "a"), "a")
        edges = materialise(
            moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        )
    else:
        raise RuntimeError("linking did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
