"""Keyed writes as DataFrame transforms: each returns the new version of the table.

Parquet has no MERGE, so a write is "compute the next version, publish it" (see sinks.publish).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A batch names one key more than once."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter("count > 1")


def require_unique(df: DataFrame, keys: list[str], show: int = 20) -> DataFrame:
    """Return ``df``, or raise naming some of the keys it repeats."""
    found = duplicate_keys(df, keys).limit(show).collect()
    if found:
        named = ", ".join(str(tuple(r[k] for k in keys)) for r in found)
        raise DuplicateKeyError(f"duplicate keys on {keys}: {named}")
    return df


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, whose keys must be unique: a repeated key raises when the result is used.

    The check is a filter, so it also holds where only the keys or a count are asked for.
    """
    counted = df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    named = F.concat(F.lit(f"duplicate key on {', '.join(keys)}: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    return counted.filter(F.assert_true(F.col("_n") == 1, named).isNull()).drop("_n")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest by ``order``. Combines map-side, so a hot key is cheap."""
    rest = [c for c in df.columns if c not in keys]
    lead = [*order, *[c for c in rest if c not in order]]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*lead)).alias("_r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def upsert_replace(existing: DataFrame, incoming: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Incoming rows replace whole rows of the same key."""
    if check:
        require_unique(incoming, keys)
    kept = existing.join(incoming.select(*keys), keys, "left_anti").select(*existing.columns)
    return kept.unionByName(incoming.select(*existing.columns))


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Incoming rows are added where the key is new; the first row of a repeated key counts."""
    new = first_per_key(incoming.select(*existing.columns), keys, order)
    return existing.unionByName(new.join(existing.select(*keys), keys, "left_anti").select(*existing.columns))


def collapse_last_non_null(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key; each column takes its last non-null value in ``order``.

    Rows equal in ``order`` are settled by the value itself, so the result does not depend on how
    the input is partitioned.
    """
    picks = []
    for c in df.columns:
        if c in keys:
            continue
        rank = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(c).alias("v"))
        picks.append(F.max(F.when(F.col(c).isNotNull(), rank))["v"].alias(c))
    return df.groupBy(*keys).agg(*picks).select(*df.columns)


def upsert_sparse(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Only non-null incoming fields overwrite; unknown keys are added."""
    new = collapse_last_non_null(incoming, keys, order).select(*existing.columns)
    values = [c for c in existing.columns if c not in keys]
    joined = existing.alias("e").join(
        new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in values]), keys, "full_outer"
    )
    return joined.select(
        *[F.col(c) if c in keys else F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) for c in existing.columns]
    )


def update_matched(existing: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Set ``columns`` where the key has a change; other keys and other columns stay."""
    marked = changes.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = existing.join(marked, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in existing.columns
        ]
    )


def fold_batches(batches: DataFrame, keys: list[str], batch: str, kind: str, updated: list[str]) -> DataFrame:
    """Replay ordered batches of inserts and updates in one pass.

    ``batches`` holds all rows with their batch number and ``kind`` ('insert' or 'update'). A key's
    row is its first insert; each column of ``updated`` takes the last non-null update of a later or
    equal batch. Updates of keys never inserted, or updates from before the insert, do nothing.
    Replaying a batch changes nothing.
    """
    values = [c for c in batches.columns if c not in (*keys, batch, kind)]
    is_insert = F.col(kind) == "insert"
    picks = [F.min(F.when(is_insert, F.struct(F.col(batch).alias("b"), *values))).alias("_i")]
    for c in updated:
        given = F.struct(F.col(batch).alias("b"), F.col(c).alias("v"))
        picks.append(F.max(F.when(~is_insert & F.col(c).isNotNull(), given)).alias(f"_u_{c}"))
    # The latest update of a column decides: were it older than the insert, so were all others.
    folded = batches.groupBy(*keys).agg(*picks).filter("_i is not null")
    return folded.select(
        *keys,
        *[
            F.when(F.col(f"_u_{c}.b") >= F.col("_i.b"), F.col(f"_u_{c}.v")).otherwise(F.col(f"_i.{c}")).alias(c)
            if c in updated
            else F.col(f"_i.{c}").alias(c)
            for c in values
        ],
    )


def changed(columns: list[str], old: str, new: str) -> Column:
    """True where any column differs, NULLs compared as values."""
    tests = [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def stamp_audit(
    existing: DataFrame, incoming: DataFrame, keys: list[str], now: Column | None = None, touched: str = "updated_at"
) -> DataFrame:
    """Upsert with audit columns: ``created_at`` stays, ``touched`` moves only for changed rows."""
    now = F.current_timestamp() if now is None else now
    values = [c for c in incoming.columns if c not in keys]
    o = existing.withColumn("_old", F.lit(True)).alias("o")
    n = incoming.withColumn("_new", F.lit(True)).alias("n")
    j = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    moved = F.col("_new").isNotNull() & (F.col("_old").isNull() | changed(values, "o", "n"))
    return j.select(
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys],
        *[F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in values],
        F.when(F.col("_old").isNull(), now).otherwise(F.col("o.created_at")).alias("created_at"),
        F.when(moved, now).otherwise(F.col(f"o.{touched}")).alias(touched),
    )
