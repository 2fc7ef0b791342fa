"""Counts kept up to date from change sets, and rankings over them.

A count per entity (a director's titles, an actor's cast entries) is a sum over the rows of a table, so a change set moves it
by the entries of the rows it brings less those of the rows it takes away. Only changed rows are unfolded and only
touched entities are summed again; a ranking then reads the counts, not the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.plans.films import name_late

Entries = Callable[[DataFrame], DataFrame]


def recount(rows: DataFrame, entries: Entries) -> DataFrame:
    """(entity columns, n) from the whole table; ``entries`` unfolds rows to one row per entry."""
    found = entries(rows)
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n"))


def deltas(changes: DataFrame, old: DataFrame, keys: list[str], entries: Entries) -> DataFrame:
    """(entity columns, n): by how much each entity's count moves from ``old`` by a change set of it.

    ``changes`` is a result of ``snapshots.diff``; rows to update or delete are looked up in ``old``. An entity whose
    entries come and go alike is left out.
    """
    come = entries(changes.where("op <> 'delete'").drop("op"))
    go = entries(old.join(changes.where("op <> 'insert'").select(*keys), keys, "left_semi"))
    signed = come.withColumn("n", F.lit(1).cast("long")).unionByName(go.withColumn("n", F.lit(-1).cast("long")))
    return signed.groupBy(*come.columns).agg(F.sum("n").alias("n")).where("n <> 0")


def moved(counts: DataFrame, change: DataFrame) -> DataFrame:
    """The counts after ``deltas``; an entity without entries goes, and a count below zero is an error of the input."""
    names = [c for c in counts.columns if c != "n"]
    summed = counts.unionByName(change).groupBy(*names).agg(F.sum("n").alias("n"))
    wrong = F.concat(F.lit("count below zero: "), F.concat_ws(", ", *[F.col(c).cast("string") for c in names]))
    return summed.where(F.assert_true(F.col("n") >= 0, wrong).isNull()).where("n > 0")


def top(counts: DataFrame, people: DataFrame, n: int, person: str = "nombre", count: str = "cantidad") -> DataFrame:
    """The ``n`` people (column nconst) with the greatest counts, equal ones by id, with their names."""
    ranked = name_late(counts.withColumnRenamed("n", "cantidad"), people, n, [F.desc("cantidad"), F.asc("nconst")])
    return ranked.select("nconst", F.col("primaryName").alias(person), F.col("cantidad").alias(count))
