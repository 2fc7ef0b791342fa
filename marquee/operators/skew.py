"""Arrays of bounded length per key.

Reducing aggregates (count, max_by, min_by) need nothing from here: their map-side combine leaves
one row per key and task. An array per key keeps every row of the key, so it is cut into pages by a
rule that looks at the element alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.ordered import within

# Places of an ordering that one nested array covers.
PAGE_SIZE = 10_000


def page_of(ordering: Column, page_size: int = PAGE_SIZE) -> Column:
    """Page of an element: orderings 1..page_size lie on page 0, the next ones on page 1, and so on.

    An element without a usable ordering (NULL or below 1) lies on page 0. A page is bounded only if the orderings of
    a key are distinct and usable: all elements that repeat one, or have none, share a page.
    """
    place = F.greatest(F.coalesce(ordering.cast("bigint"), F.lit(1)), F.lit(1)) - 1
    return F.floor(place / page_size).cast("bigint")


def paged_lists(
    df: DataFrame, key: str, ordering: Column, element: Column, name: str, page_size: int = PAGE_SIZE,
    heads: DataFrame | None = None,
) -> DataFrame:
    """Collect ``element`` (a struct) into sorted arrays, one row per (``key``, ``page``).

    The page follows from the ordering, so neighbours stay neighbours and a key of any size is cut
    alike, if its orderings are distinct. ``heads`` (a frame with ``key``) gives each of its keys a page 0, empty if need be.
    """
    rows = df.select(F.col(key), page_of(ordering, page_size).alias("page"), element.alias("_e"))
    if heads is not None:
        kind = rows.schema["_e"].dataType
        rows = rows.unionByName(heads.select(key, F.lit(0).cast("bigint").alias("page"), F.lit(None).cast(kind).alias("_e")))
    return rows.groupBy(key, "page").agg(F.sort_array(F.collect_list("_e")).alias(name))


def ranked_lists(
    df: DataFrame, key: str, element: Column, name: str, page_size: int = PAGE_SIZE, heads: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Collect ``element`` (a struct) into sorted arrays of at most ``page_size``, one row per (``key``, ``page``).

    The page follows from the rank of the element among those of its key, in the order of the struct's fields, NULL
    first. So pages are full and bounded whatever the orderings are: missing, repeated or far apart. Ranks come from
    slices of the whole order, so no task holds a key; elements that agree in all fields are interchangeable.
    ``heads`` as in ``paged_lists``.
    """
    ranked = within(df.select(F.col(key), element.alias("_e")), [key], ["_e"], number="_n", slices=slices)
    rows = ranked.select(key, F.floor((F.col("_n") - 1) / page_size).cast("bigint").alias("page"), F.struct("_n", "_e").alias("_e"))
    if heads is not None:
        kind = rows.schema["_e"].dataType
        rows = rows.unionByName(heads.select(key, F.lit(0).cast("bigint").alias("page"), F.lit(None).cast(kind).alias("_e")))
    pages = rows.groupBy(key, "page").agg(F.sort_array(F.collect_list("_e")).alias("_es"))
    return pages.select(key, "page", F.transform("_es", lambda e: e["_e"]).alias(name))
