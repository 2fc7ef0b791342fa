"""Digest trees: what differs between two versions of a table, without reading what does not.

The keys of a table are cut into ranges, its leaves. A leaf has the number of its rows and two sums of their hashes that do
not depend on their order; ``FAN`` leaves make a node, ``FAN`` nodes one above, up to a root. Two trees over the same
ranges are compared from the root down: equal roots end the comparison, and otherwise only leaves below differing nodes are
looked at. Rows are read and joined in the differing leaves alone.

A stored version is a folder: ``bounds`` (one row), ``tree`` (a row per node), and ``rows``, sorted by leaf and key, so that
row groups of other leaves are passed over. Later versions take over the bounds of the one they follow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import snapshots as SN
from marquee.operators.ordered import order_key, range_bounds, range_number

LEAVES = 1024
FAN = 32
TREE = "level int, node long, n long, a long, b long"


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row; a NULL counts with its place, so that it differs from any other NULL and from nothing."""
    nulls = F.array(*[F.col(c).isNull() for c in columns])
    return F.xxhash64(F.lit(1), nulls, *columns), F.xxhash64(F.lit(2), *columns, nulls)


def with_leaf(df: DataFrame, keys: list[str], bounds: DataFrame) -> DataFrame:
    """``df`` with ``_leaf``, the range its key falls into; keys beyond all bounds belong to the last one."""
    held = df.withColumn("_bounds", bounds.select("bounds").scalar())
    return held.withColumn("_leaf", range_number(order_key(keys), F.col("_bounds"), LEAVES)).drop("_bounds")


def tree(leafed: DataFrame, columns: list[str]) -> DataFrame:
    """The nodes of rows with ``_leaf``, level 0 being the leaves: as TREE. An empty table has no nodes.

    Sums of hashes are exclusive ors, so tasks combine theirs before the shuffle and any order gives the same.
    """
    a, b = row_hashes(columns)
    leaves = leafed.select("_leaf", a.alias("a"), b.alias("b")).groupBy(F.col("_leaf").cast("long").alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    # Every level follows from the leaves, of which there are few.
    spread = leaves.select(F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright("node", 5 * level).alias("node"))
                                               for level in range(_levels())])).alias("at"), "n", "a", "b")
    return spread.groupBy("at.level", "at.node").agg(F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))


def _levels() -> int:
    level, nodes = 1, LEAVES
    while nodes > 1:
        level, nodes = level + 1, -(-nodes // FAN)
    return level


def write_version(df: DataFrame, keys: list[str], path: str, follows: str | None = None) -> None:
    """Store a version; one that ``follows`` another takes over its ranges, so that the two can be compared."""
    spark = df.sparkSession
    path = path.rstrip("/")
    bounds = spark.read.parquet(f"{follows.rstrip('/')}/bounds") if follows else range_bounds(df, keys, LEAVES)
    bounds.coalesce(1).write.parquet(f"{path}/bounds")
    leafed = with_leaf(df, keys, spark.read.parquet(f"{path}/bounds"))
    leafed.repartitionByRange("_leaf", *keys).sortWithinPartitions("_leaf", *keys).write.parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    tree(stored, sorted(c for c in stored.columns if c != "_leaf")).coalesce(1).write.parquet(f"{path}/tree")


def _nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TREE).parquet(f"{path.rstrip('/')}/tree")


def differing(old: DataFrame, new: DataFrame, level: int, below: list[int] | None) -> list[int]:
    """The nodes of a level that differ, among the children of the nodes ``below`` (None: all).

    A level has at most LEAVES nodes, so the list is bounded.
    """
    def at(tree_: DataFrame) -> DataFrame:
        rows = tree_.where(F.col("level") == level)
        return rows if below is None else rows.where(F.shiftright("node", 5).isin(below))

    o, n = (at(t).select("node", F.struct("n", "a", "b").alias(name)) for t, name in ((old, "o"), (new, "w")))
    found = o.join(n, "node", "full_outer").where(~F.col("o").eqNullSafe(F.col("w"))).select("node").collect()
    return sorted(r["node"] for r in found)


def changed_leaves(spark: SparkSession, old: str, new: str) -> list[int]:
    """The leaves in which two stored versions differ, from the root down; no rows are read."""
    bounds = [spark.read.parquet(f"{p.rstrip('/')}/bounds") for p in (old, new)]
    if not bounds[0].exceptAll(bounds[1]).isEmpty():
        raise ValueError("the versions have other ranges; the later one must follow the earlier one")
    trees = _nodes(spark, old), _nodes(spark, new)
    below: list[int] | None = None
    for level in range(_levels() - 1, -1, -1):
        below = differing(*trees, level, below)
        if not below:
            return []
    return below


def unchanged(spark: SparkSession, old: str, new: str) -> bool:
    """Whether two stored versions hold the same rows; their roots decide."""
    return not differing(_nodes(spark, old), _nodes(spark, new), _levels() - 1, None)


def _within(leaves: list[int]) -> Column:
    """The leaves as ranges, which row-group statistics can answer."""
    ranges: list[list[int]] = []
    for leaf in leaves:
        if ranges and leaf == ranges[-1][1] + 1:
            ranges[-1][1] = leaf
        else:
            ranges.append([leaf, leaf])
    return reduce(lambda x, y: x | y, [F.col("_leaf").between(a, b) for a, b in ranges], F.lit(False))


def version(spark: SparkSession, path: str, leaves: list[int] | None = None) -> DataFrame:
    """The rows of a stored version, or those of some of its leaves."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows")
    return (rows if leaves is None else rows.where(_within(leaves))).drop("_leaf")


def diff_versions(spark: SparkSession, old: str, new: str, keys: list[str]) -> DataFrame:
    """The change set between two stored versions, as ``snapshots.diff`` gives it: only differing leaves are read."""
    leaves = changed_leaves(spark, old, new)
    return SN.diff(version(spark, old, leaves), version(spark, new, leaves), keys)
