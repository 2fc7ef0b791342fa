"""Constraint checks and cascading removal.

Every check aggregates before it shuffles: keys and references are counted per value first, so a
value that fills a third of a table costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import schemas as S


def pk_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per required column, how many rows lack it (one pass over the table)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("rows")) for c in columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.column", "p.rows")


def enum_violations(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values outside the allowed list, with their row count."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def length_violations(df: DataFrame, limits: list[tuple[str, int | None]]) -> DataFrame:
    """Per limited column, how many values are too long and the longest one."""
    limited = [(c, n) for c, n in limits if n is not None]
    aggs = []
    for c, n in limited:
        aggs += [F.count_if(F.length(c) > n).alias(f"{c}__rows"), F.max(F.length(c)).alias(f"{c}__longest")]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(n).alias("limit"),
                F.col(f"{c}__rows").alias("rows"), F.col(f"{c}__longest").alias("longest"),
            )
            for c, n in limited
        ]
    )
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def too_long(df: DataFrame, limits: list[tuple[str, int | None]]) -> DataFrame:
    """The rows themselves that a length limit rejects."""
    tests = [F.length(c) > n for c, n in limits if n is not None]
    return df.filter(reduce(lambda a, b: a | b, tests))


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Referencing values without a parent, with the number of child rows holding each."""
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return used.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def fk_report(tables: dict[str, DataFrame], references: list[tuple] | None = None) -> DataFrame:
    """One row per broken reference value over all foreign keys."""
    parts = []
    for child, column, parent, parent_column, _ in references or S.FOREIGN_KEYS:
        if child in tables and parent in tables:
            bad = fk_violations(tables[child], column, tables[parent], parent_column)
            parts.append(
                bad.select(
                    F.lit(child).alias("table"), F.lit(column).alias("column"), F.col("value").cast("string"), "rows"
                )
            )
    return reduce(DataFrame.unionByName, parts)


def cascade_delete(
    tables: dict[str, DataFrame], titles: DataFrame | None = None, people: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Remove titles and people (frames of keys) with all rows that depend on them."""
    removed = {"titles": titles, "people": people}
    out = dict(tables)
    for parent, gone in removed.items():
        if gone is None:
            continue
        key = S.PRIMARY_KEYS[parent][0]
        gone = gone.select(key).distinct()
        out[parent] = out[parent].join(gone, key, "left_anti")
        for child, column, of, _, cascades in S.FOREIGN_KEYS:
            if of == parent and cascades and child in out:
                marks = gone.select(F.col(key).alias(column))
                out[child] = out[child].join(marks, column, "left_anti").select(*tables[child].columns)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, stacked."""
    parts = [df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(n).alias("tabla"), "total") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def check_star(tables: dict[str, DataFrame]) -> DataFrame:
    """All violations of the star schema as (check, table, column, rows); empty when it is sound."""
    parts = []

    def add(check: str, table: str, column: str, bad: DataFrame) -> None:
        total = bad.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"))
        parts.append(total.select(F.lit(check).alias("check"), F.lit(table).alias("table"),
                                  F.lit(column).alias("column"), "rows"))

    for spec in (S.PRIMARY_KEYS, S.UNIQUE_KEYS):
        for table, keys in spec.items():
            if table in tables:
                add("unique", table, ",".join(keys), pk_duplicates(tables[table], keys))
    for table, columns in S.REQUIRED.items():
        if table in tables:
            nulls = null_violations(tables[table], [*S.PRIMARY_KEYS.get(table, []), *columns])
            parts.append(nulls.select(F.lit("required").alias("check"), F.lit(table).alias("table"), "column", "rows"))
    for (table, column), allowed in S.ALLOWED.items():
        if table in tables:
            add("allowed", table, column, enum_violations(tables[table], column, allowed))
    for child, column, parent, parent_column, _ in S.FOREIGN_KEYS:
        if child in tables and parent in tables:
            add("reference", child, column, fk_violations(tables[child], column, tables[parent], parent_column))
    return reduce(DataFrame.unionByName, parts).filter("rows > 0")
