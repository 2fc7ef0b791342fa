"""Nested title, people and aka documents.

The key of a title document is (tconst, page). Page 0 exists for every title and holds the principals
of the orderings 1 to PAGE_SIZE; page 1 those of the next PAGE_SIZE orderings, and so on, each with
the same title fields. Title-level questions read page 0, principal-level ones read every page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import columns as X
from marquee.operators.skew import PAGE_SIZE, paged_lists, ranked_lists
from marquee.operators.upsert import collapse_last_non_null


def title_base(basics: DataFrame) -> DataFrame:
    """Title fields of the document; types keep their source spelling, lists become arrays."""
    return basics.filter(F.col("tconst").isNotNull()).select(
        "tconst",
        F.col("titletype").alias("titleType"),
        F.col("primarytitle").alias("primaryTitle"),
        F.col("originaltitle").alias("originalTitle"),
        X.flag(F.col("isadult")).alias("isAdult"),
        X.year_or_null(F.col("startyear")).cast("int").alias("startYear"),
        X.year_or_null(F.col("endyear")).cast("int").alias("endYear"),
        X.digits_or_null(F.col("runtimeminutes"), "int").alias("runtimeMinutes"),
        X.list_or_empty(F.col("genres")).alias("genres"),
    )


def people_docs(names: DataFrame) -> DataFrame:
    return names.filter(F.col("nconst").isNotNull()).select(
        "nconst",
        F.col("primaryname").alias("primaryName"),
        X.year_or_null(F.col("birthyear")).cast("int").alias("birthYear"),
        X.year_or_null(F.col("deathyear")).cast("int").alias("deathYear"),
        X.list_or_empty(F.col("primaryprofession")).alias("primaryProfession"),
        X.list_or_empty(F.col("knownfortitles")).alias("knownForTitles"),
    )


def aka_docs(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("titleid").isNotNull()).select(
        F.col("titleid").alias("titleId"),
        X.digits_or_null(F.col("ordering"), "int").alias("ordering"),
        "title", "region", "language", "types", "attributes",
        X.flag(F.col("isoriginaltitle")).alias("isOriginalTitle"),
    )


def rating_part(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        "tconst",
        F.struct(
            X.float_or_null(F.col("averagerating")).alias("average"), F.col("numvotes").cast("bigint").alias("votes")
        ).alias("rating"),
    )


def crew_part(crew: DataFrame) -> DataFrame:
    return crew.select(
        "tconst",
        F.struct(
            X.list_or_empty(F.col("directors")).alias("directors"), X.list_or_empty(F.col("writers")).alias("writers")
        ).alias("crew"),
    )


def episode_part(episode: DataFrame) -> DataFrame:
    return episode.select(
        "tconst",
        F.col("parenttconst").alias("parent_tconst"),
        X.digits_or_null(F.col("seasonnumber"), "int").alias("season_number"),
        X.digits_or_null(F.col("episodenumber"), "int").alias("episode_number"),
    )


def principal_struct(characters: str = "json") -> Column:
    """One cast entry. ``characters='split'`` strips brackets and quotes instead of reading JSON."""
    read = X.json_list if characters == "json" else X.stripped_list
    return F.struct(
        X.digits_or_null(F.col("ordering"), "int").alias("ordering"),
        "nconst", "category", "job",
        read(F.col("characters")).alias("characters"),
    )


def embed(titles: DataFrame, part: DataFrame) -> DataFrame:
    """Attach a one-to-one part; parts without a title are left out, titles without a part keep NULL.

    ``part`` has at most one row per tconst (see ``loaded``).
    """
    return titles.join(part, "tconst", "left")


def embed_principals(
    titles: DataFrame, principals: DataFrame, characters: str = "json", page_size: int = PAGE_SIZE, pages_by: str = "ordering"
) -> DataFrame:
    """Attach the cast arrays, in billing order, one row per title and page.

    ``pages_by`` says what a page is: places of the ``ordering`` (the page of an entry follows from the entry alone),
    or of the ``rank`` among the title's entries (pages are bounded also where orderings are missing or repeated).
    """
    if pages_by not in ("ordering", "rank"):
        raise ValueError("pages_by must be ordering or rank")
    rows = principals.filter(F.col("tconst").isNotNull())
    if pages_by == "rank":
        pages = ranked_lists(rows, "tconst", principal_struct(characters), "principals", page_size, heads=titles)
        return titles.join(pages, "tconst")
    place = X.digits_or_null(F.col("ordering"), "int")
    pages = paged_lists(rows, "tconst", place, principal_struct(characters), "principals", page_size, heads=titles)
    return titles.join(pages, "tconst")


def loaded(raw: DataFrame, key: str) -> DataFrame:
    """One row per key, as an upsert by key leaves it: what is loaded twice is there once, and per column
    the greatest value stays (a distributed read has no file order). Rows without a key go."""
    return collapse_last_non_null(raw.filter(F.col(key).isNotNull()), [key], [])


def build_documents(
    staging: dict[str, DataFrame], characters: str = "json", page_size: int = PAGE_SIZE,
    store: Callable[[str, DataFrame], DataFrame] | None = None, pages_by: str = "ordering",
) -> dict[str, DataFrame]:
    """The three document collections: lazy frames, or written tables with ``store`` (name, frame -> table).

    Titles, people and the one-to-one parts are upserted by key; principals and alternative titles
    are one-to-many and keep all their rows.
    """
    titles = title_base(loaded(staging["title_basics"], "tconst"))
    titles = embed(titles, rating_part(loaded(staging["title_ratings"], "tconst")))
    titles = embed(titles, crew_part(loaded(staging["title_crew"], "tconst")))
    titles = embed(titles, episode_part(loaded(staging["title_episode"], "tconst")))
    built = {
        "titles": embed_principals(titles, staging["title_principals"], characters, page_size, pages_by),
        "people": people_docs(loaded(staging["name_basics"], "nconst")),
        "akas": aka_docs(staging["title_akas"]),
    }
    return {name: store(name, df) for name, df in built.items()} if store else built


def to_json_records(df: DataFrame) -> DataFrame:
    """One JSON text per row; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true"}).alias("value"))
