"""Star schema: dimensions, bridges and episodes, built from staging frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import columns as X
from marquee.operators.clean import clean_people, clean_ratings, clean_titles
from marquee.operators.ordered import within
from marquee.operators.upsert import first_per_key

def _dimension(values: DataFrame, id_name: str, value_name: str) -> DataFrame:
    """Distinct values numbered in name order, however many there are."""
    numbered = within(values.filter(F.col(value_name).isNotNull()).distinct(), [], [value_name], number=id_name)
    return numbered.select(F.col(id_name).cast("int").alias(id_name), value_name)


def with_dimension_id(rows: DataFrame, dimension: DataFrame, id_name: str, value_name: str, column: str) -> DataFrame:
    """Replace the text in ``column`` by its dimension id; rows with an unknown value are dropped.

    How the two meet follows their sizes: a short dimension is sent to the rows, a long one is
    shuffled, with frequent values split.
    """
    ids = dimension.select(id_name, F.col(value_name).alias(column))
    return rows.join(ids, column).drop(column)


def genres_dim(basics: DataFrame) -> DataFrame:
    listed = basics.filter(X.present(F.col("genres")))
    return _dimension(listed.select(F.explode(X.split_list(F.col("genres"))).alias("genre_name")), "genre_id",
                      "genre_name")


def categories_dim(principals: DataFrame) -> DataFrame:
    named = principals.filter(X.present(F.col("category")))
    return _dimension(named.select(F.col("category").alias("category_name")), "category_id", "category_name")


def title_genres(basics: DataFrame, genres: DataFrame, titles: DataFrame) -> DataFrame:
    """One row per title and listed genre, with the place in the list."""
    return (
        basics.filter(X.has_key(F.col("tconst")))
        .select("tconst", "genres")
        .join(titles.select("tconst"), "tconst", "left_semi")
        .select("tconst", F.posexplode(X.split_list(F.col("genres"))).alias("pos", "genre_name"))
        .transform(with_dimension_id, genres, "genre_id", "genre_name", "genre_name")
        .select("tconst", "genre_id", (F.col("pos") + 1).cast("smallint").alias("genre_order"))
    )


def title_principals(
    principals: DataFrame, categories: DataFrame, titles: DataFrame, people: DataFrame
) -> DataFrame:
    """Cast and staff rows whose title, person and category are all known. Copies are kept."""
    return (
        principals.filter(X.has_key(F.col("tconst")))
        .transform(with_dimension_id, categories, "category_id", "category_name", "category")
        .join(titles.select("tconst"), "tconst", "left_semi")
        .join(people.select("nconst"), "nconst", "left_semi")
        .select(
            "tconst",
            F.col("ordering").cast("smallint").alias("ordering"),
            "nconst",
            "category_id",
            X.mark_to_null(F.col("job")).alias("job"),
            X.mark_to_null(F.col("characters")).alias("characters"),
        )
    )


def title_crew(crew: DataFrame, titles: DataFrame, people: DataFrame) -> DataFrame:
    """Director and writer rows. Both lists are unfolded in one pass, so crew is read once and
    each reference check joins once."""
    keyed = crew.filter(X.has_key(F.col("tconst"))).join(titles.select("tconst"), "tconst", "left_semi")

    def role(column: str, name: str):
        people_of = F.when(X.present(F.col(column)), X.split_list(F.col(column)))
        empty = F.array().cast("array<struct<nconst:string,crew_type:string>>")
        return F.coalesce(
            F.transform(people_of, lambda n: F.struct(n.alias("nconst"), F.lit(name).alias("crew_type"))), empty
        )

    return (
        keyed.select("tconst", F.explode(F.concat(role("directors", "director"), role("writers", "writer"))).alias("m"))
        .select("tconst", "m.nconst", "m.crew_type")
        .join(people.select("nconst"), "nconst", "left_semi")
        .select("tconst", "nconst", "crew_type")
    )


def episodes(episode: DataFrame, titles: DataFrame) -> DataFrame:
    """Episodes whose own title and series title are both kept; the first row of a key wins."""
    kept = titles.select("tconst")
    typed = (
        episode.filter(X.has_key(F.col("tconst")))
        .join(kept, "tconst", "left_semi")
        .join(kept.withColumnRenamed("tconst", "parenttconst"), "parenttconst", "left_semi")
        .select(
            F.col("tconst").alias("episode_tconst"),
            F.col("parenttconst").alias("parent_tconst"),
            X.digits_or_null(F.col("seasonnumber"), "smallint").alias("season_number"),
            X.digits_or_null(F.col("episodenumber"), "int").alias("episode_number"),
        )
    )
    return first_per_key(typed, ["episode_tconst"], ["parent_tconst", "season_number", "episode_number"])


def akas(raw: DataFrame) -> DataFrame:
    """Alternative titles, one row each."""
    return raw.filter(X.has_key(F.col("titleid"))).select(
        "titleid",
        X.digits_or_null(F.col("ordering"), "int").alias("ordering"),
        "title", "region", "language", "types", "attributes",
        X.flag(F.col("isoriginaltitle")).alias("is_original_title"),
    )


STAR_STEPS = {
    "titles": lambda s, t, all_types: clean_titles(s["title_basics"], all_types),
    "people": lambda s, t, _: clean_people(s["name_basics"]),
    "ratings": lambda s, t, _: clean_ratings(s["title_ratings"], t["titles"]),
    "genres": lambda s, t, _: genres_dim(s["title_basics"]),
    "title_genres": lambda s, t, _: title_genres(s["title_basics"], t["genres"], t["titles"]),
    "categories": lambda s, t, _: categories_dim(s["title_principals"]),
    "title_principals": lambda s, t, _: title_principals(
        s["title_principals"], t["categories"], t["titles"], t["people"]),
    "title_crew": lambda s, t, _: title_crew(s["title_crew"], t["titles"], t["people"]),
    "episodes": lambda s, t, _: episodes(s["title_episode"], t["titles"]),
    "akas": lambda s, t, _: akas(s["title_akas"]),
}


def build_star(
    staging: dict[str, DataFrame], keep_all_types: bool = False,
    store: Callable[[str, DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """All star-schema tables, in the order their references need.

    Without ``store`` the frames stay lazy. ``store`` (name, frame -> written table) keeps each table
    as it is built, so that parents are cleaned once and not again for every child.
    """
    star: dict[str, DataFrame] = {}
    for name, step in STAR_STEPS.items():
        if name == "akas" and "title_akas" not in staging:
            continue
        built = step(staging, star, keep_all_types)
        star[name] = store(name, built) if store else built
    return star
