"""Table versions: change sets, applying them, choosing a restore chain, as-of rebuilds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.upsert import changed


def diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to insert, update or delete to get from ``old`` to ``new``; deletes carry NULL values.

    Both versions have unique keys. NULL equals NULL, unchanged rows are left out.
    """
    values = [c for c in new.columns if c not in keys]
    o = old.select(*new.columns).withColumn("_in", F.lit(True)).alias("o")
    n = new.withColumn("_in", F.lit(True)).alias("n")
    j = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    op = (
        F.when(F.col("o._in").isNull(), "insert")
        .when(F.col("n._in").isNull(), "delete")
        .when(changed(values, "o", "n"), "update")
    )
    return j.select(
        op.alias("op"),
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys],
        *[F.col(f"n.{c}").alias(c) for c in values],
    ).filter(F.col("op").isNotNull())


def has_changes(changes: DataFrame) -> bool:
    """False for an empty change set, which a snapshot run skips without an error."""
    return not changes.isEmpty()


def apply_changes(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The version that follows ``base`` after one change set."""
    kept = base.join(changes.select(*keys), keys, "left_anti").select(*base.columns)
    return kept.unionByName(changes.filter("op <> 'delete'").select(*base.columns))


def rebuild(full: DataFrame, change_sets: list[tuple[int, DataFrame]], keys: list[str]) -> DataFrame:
    """A full version plus numbered change sets, in one aggregation by key.

    The last entry of a key counts. One shuffle whatever the length of the chain, and versions of
    one key combine map-side.
    """
    values = [c for c in full.columns if c not in keys]
    parts = [full.select(*keys, *values, F.lit(0).alias("_seq"), F.lit(True).alias("_live"))]
    for seq, changes in change_sets:
        parts.append(
            changes.select(*keys, *values, F.lit(seq).alias("_seq"), (F.col("op") != "delete").alias("_live"))
        )
    stacked = reduce(DataFrame.unionByName, parts)
    last = stacked.groupBy(*keys).agg(F.max(F.struct("_seq", "_live", *values)).alias("_r"))
    return last.filter("_r._live").select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in full.columns])


def rebuild_log(log: DataFrame, keys: list[str], seq: str, until: Column | None = None) -> DataFrame:
    """As-of rebuild from one log of (op, keys, values, seq), entries after ``until`` left out."""
    values = [c for c in log.columns if c not in (*keys, seq, "op")]
    rows = log if until is None else log.filter(F.col(seq) <= until)
    last = rows.groupBy(*keys).agg(F.max(F.struct(F.col(seq).alias("s"), F.col("op").alias("op"), *values)).alias("_r"))
    return last.filter("_r.op <> 'delete'").select(*keys, *[F.col(f"_r.{c}").alias(c) for c in values])


def restore_chain(
    catalogue: DataFrame, target: Column | None = None, group: str = "stanza", kind: str = "type", ts: str = "ts",
    label: str = "label",
) -> DataFrame:
    """Snapshots needed to restore each group at ``target`` (default: latest), with their role.

    The latest full not after the target, the latest differential behind it, then every
    incremental behind the later of the two; of snapshots taken at one time the one with the
    greatest label counts as the latest. Two passes of map-side combined maxima find the start of
    each chain.
    """
    rows = catalogue if target is None else catalogue.filter(F.col(ts) <= target)
    at = F.struct(F.col(ts).alias("ts"), F.col(label).alias("label"))
    fulls = rows.filter(F.col(kind) == "full").groupBy(group).agg(F.max(at).alias("_full"))
    behind = rows.join(fulls, group).filter(F.col(ts) >= F.col("_full.ts"))
    diffs = behind.filter(F.col(kind) == "diff").groupBy(group).agg(F.max(at).alias("_diff"))
    chain = behind.join(diffs, group, "left")
    role = (
        F.when((F.col(kind) == "full") & (at == F.col("_full")), "full")
        .when((F.col(kind) == "diff") & (at == F.col("_diff")), "diff")
        .when((F.col(kind) == "incr") & (F.col(ts) > F.coalesce("_diff.ts", "_full.ts")), "incr")
    )
    return chain.withColumn("role", role).filter("role is not null").drop("_full", "_diff")


def restore_set(catalogue: DataFrame, label: str, label_column: str = "label", group: str = "stanza",
                ts: str = "ts") -> DataFrame:
    """Chain of a named snapshot: the restore chain as of that snapshot's own time."""
    named = catalogue.filter(F.col(label_column) == label).groupBy(group).agg(F.max(ts).alias("_at"))
    upto = catalogue.join(named, group).filter(F.col(ts) <= F.col("_at")).drop("_at")
    return restore_chain(upto, group=group, ts=ts, label=label_column)
