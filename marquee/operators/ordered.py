"""Previous value, next value and row number within ordered groups, whatever the size of a group.

Rows are dealt to slices by ranges of the whole order (group first), so a slice holds a bounded
share of the table even where one group, or one value of the first order column, fills most of it.
Windows run within a slice, and one summary row per slice and group that a bound cuts carries the state across slices.
The slice of a row follows from its own values and a short list of bounds, so a row computed again, for
a second use or after a lost executor, falls into the same slice and nothing has to be kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import let

# Rows drawn for each slice. More draws make the slices more alike in size.
DRAWS = 20
DIGIT = 16


def order_key(columns: list[str]) -> Column:
    """The columns as one value that sorts like them, NULL first."""
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])


def range_bounds(df: DataFrame, columns: list[str], ranges: int) -> DataFrame:
    """One row with ``bounds``: at most ``ranges - 1`` sorted keys that cut the rows into ranges of about equal size.

    A uniform draw of ``DRAWS`` keys a range decides: of each hash cell the key with the smallest second hash. Tasks
    send at most one key a cell, and the draw depends on the rows alone, not on how they are partitioned.
    """
    cells = ranges * DRAWS
    cell, rank = F.pmod(F.xxhash64(F.lit(1), *columns), F.lit(cells)), F.xxhash64(F.lit(2), *columns)
    drawn = df.select(order_key(columns).alias("k"), cell.alias("cell"), rank.alias("h")).groupBy("cell").agg(
        F.min_by("k", "h").alias("k"))
    keys = drawn.agg(F.sort_array(F.collect_list("k")).alias("ks"))  # at most ``cells`` keys
    every = F.transform(F.sequence(F.lit(1), F.lit(max(1, ranges - 1))),
                        lambda i: F.get("ks", F.floor(i * F.size("ks") / ranges).cast("int")))
    return keys.select(F.array_distinct(F.filter(every, lambda k: k.isNotNull())).alias("bounds"))


def range_number(key: Column, bounds: Column, ranges: int) -> Column:
    """How many of the sorted ``bounds`` (fewer than ``ranges``) are at most ``key``: the number of its range, from 0.

    Found digit by digit, so a row is compared with some sixteen bounds per digit and not with all.
    """
    def below(at: Column, list_: Column, step: int) -> Column:
        passed = F.size(F.filter(F.sequence(F.lit(1), F.lit(DIGIT - 1)), lambda d: F.get(list_, at + d * step - 1) <= key))
        more = at + passed * step
        return more if step == 1 else let(more, lambda found: below(found, list_, step // DIGIT))

    top = 1
    while top * DIGIT < ranges:
        top *= DIGIT
    return let(bounds, lambda list_: below(F.lit(0), list_, top))


def _cut(df: DataFrame, columns: list[str], bounds: DataFrame, slices: int) -> DataFrame:
    """``df`` with ``_slice``, the number of the range its row falls into."""
    held = df.withColumn("_bounds", bounds.scalar())
    return held.withColumn("_slice", range_number(order_key(columns), F.col("_bounds"), slices)).drop("_bounds")


def _slices(df: DataFrame, slices: int | None) -> int:
    return slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sliced(df: DataFrame, group: list[str], order: list[str], slices: int | None) -> DataFrame:
    columns, slices = [*group, *order], _slices(df, slices)
    return _cut(df, columns, range_bounds(df, columns, slices), slices)


def _shared(df: DataFrame, group: list[str], bounds: DataFrame) -> DataFrame:
    """The rows of groups that lie in more than one slice: those that a bound names, at most one group a bound."""
    if not group:
        return df
    bound = df.sparkSession.range(1).withColumn("_bounds", bounds.scalar()).select(F.explode("_bounds").alias("b"))
    named = bound.select(*[F.col(f"b.k{i}").alias(f"_g_{k}") for i, k in enumerate(group)]).distinct()
    return df.join(F.broadcast(named), [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in group], "left_semi")


def within(
    df: DataFrame,
    group: list[str],
    order: list[str],
    previous: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
    number: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add columns to ``df``:

    ``previous[name]``  = last non-null value over the rows before this one,
    ``following[name]`` = first non-null value over the rows after this one,
    ``number``          = position within the group, from 1.

    ``order`` orders the rows of a group totally; ``slices`` sets the number of ranges (default:
    the session's shuffle partitions). Nothing runs before the result is used.
    """
    previous, following = previous or {}, following or {}
    base = df
    for name, value in {**previous, **following}.items():
        base = base.withColumn(f"_v_{name}", value)
    columns, slices = [*group, *order], _slices(df, slices)
    bounds = range_bounds(base, columns, slices)
    shared = _cut(_shared(base, group, bounds), columns, bounds, slices)
    base = _cut(base, columns, bounds, slices)
    keys = ["_slice", *group]

    up = Window.partitionBy(*keys).orderBy(*[F.asc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    out = base
    for name in previous:
        out = out.withColumn(name, F.last(f"_v_{name}", ignorenulls=True).over(up))
    for name in following:
        out = out.withColumn(name, F.last(f"_v_{name}", ignorenulls=True).over(down))
    if number:
        out = out.withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.asc(c) for c in order])))

    rank = F.struct(*order)
    sums = [F.count(F.lit(1)).alias("_rows")]
    for names, pick in ((previous, F.max_by), (following, F.min_by)):
        for name in names:
            v = F.col(f"_v_{name}")
            sums.append(pick(v, F.when(v.isNotNull(), rank)).alias(f"_c_{name}"))
    # One row per slice and group, of the groups in several slices alone: at most two rows a slice, sent to the others.
    carry = shared.groupBy(*keys).agg(*sums)
    before = Window.partitionBy(*group).orderBy(F.asc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*group).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")]
    cols += [F.last(f"_c_{n}", ignorenulls=True).over(before).alias(f"_b_{n}") for n in previous]
    cols += [F.last(f"_c_{n}", ignorenulls=True).over(behind).alias(f"_b_{n}") for n in following]
    carry = carry.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *cols)
    out = out.join(F.broadcast(carry), [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys], "left")
    for name in [*previous, *following]:
        out = out.withColumn(name, F.coalesce(F.col(name), F.col(f"_b_{name}")))
    if number:
        out = out.withColumn(number, (F.col(number) + F.coalesce("_offset", F.lit(0))).cast("bigint"))
    return out.select(*df.columns, *previous, *following, *([number] if number else []))
