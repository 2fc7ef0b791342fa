"""Staging rows to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import columns as X
from marquee.operators.upsert import one_per_key
from marquee.schemas import TITLE_TYPES


def _title_type(raw: Column, keep_all_types: bool) -> Column:
    if not keep_all_types:
        # The allow-list has mixed-case members which a lower-cased value never equals, so only
        # the all-lower-case types survive.
        lowered = F.lower(raw)
        return F.when(lowered.isin(*TITLE_TYPES), lowered)
    out = None
    for member in TITLE_TYPES:
        hit = F.lower(raw) == member.lower()
        out = F.when(hit, member) if out is None else out.when(hit, member)
    return out


def clean_titles(basics: DataFrame, keep_all_types: bool = False) -> DataFrame:
    """Titles of the allowed types. ``keep_all_types`` matches the list without regard to case.

    Here and below, a key that stands twice among the kept rows raises, as it would in an upsert.
    """
    kept = (
        basics.filter(X.has_key(F.col("tconst")))
        .select(
            "tconst",
            _title_type(F.col("titletype"), keep_all_types).alias("title_type"),
            F.col("primarytitle").alias("primary_title"),
            F.col("originaltitle").alias("original_title"),
            X.flag(F.col("isadult")).alias("is_adult"),
            X.year_or_null(F.col("startyear")).alias("start_year"),
            X.year_or_null(F.col("endyear")).alias("end_year"),
            X.digits_or_null(F.col("runtimeminutes"), "int").alias("runtime_minutes"),
        )
        .filter(F.col("title_type").isNotNull())
    )
    return one_per_key(kept, ["tconst"])


def clean_people(names: DataFrame) -> DataFrame:
    """People with a name."""
    kept = (
        names.filter(X.has_key(F.col("nconst")))
        .select(
            "nconst",
            X.blank_to_null(F.col("primaryname")).alias("primary_name"),
            X.year_or_null(F.col("birthyear")).alias("birth_year"),
            X.year_or_null(F.col("deathyear")).alias("death_year"),
        )
        .filter(F.col("primary_name").isNotNull())
    )
    return one_per_key(kept, ["nconst"])


def clean_ratings(ratings: DataFrame, titles: DataFrame) -> DataFrame:
    """Ratings of kept titles. Text that is no number raises."""
    kept = (
        ratings.filter(X.has_key(F.col("tconst")))
        .join(titles.select("tconst"), "tconst", "left_semi")
        .select(
            "tconst",
            F.col("averagerating").cast("decimal(3,1)").alias("average_rating"),
            F.col("numvotes").cast("bigint").alias("num_votes"),
        )
    )
    return one_per_key(kept, ["tconst"])


def key_range(df: DataFrame, key: str, low: str, high: str | None = None) -> DataFrame:
    """Rows with ``low < key <= high``; the comparison reaches the scan."""
    out = df.filter(F.col(key) > low)
    return out if high is None else out.filter(F.col(key) <= high)


def key_page(df: DataFrame, key: str, after: str, rows: int) -> DataFrame:
    """The first ``rows`` rows behind a key, in key order (the paging helper for users)."""
    return df.filter(F.col(key) > after).orderBy(key).limit(rows)


def range_partition(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Partition by ranges of a key, for batch work over a large table."""
    return df.repartitionByRange(partitions, key)
