"""Six daily batches of a small catalogue (fixed values) and the star schema they lead to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.normalize import with_dimension_id
from marquee.operators.upsert import fold_batches
from marquee.schemas import STAR_DDL

GENRES = ["Action", "Drama", "Comedy", "Thriller", "Horror", "Sci-Fi", "Romance", "Documentary", "Animation", "Crime"]
CATEGORIES = ["actor", "actress", "director", "writer", "producer", "cinematographer", "composer", "editor", "self",
              "archive_footage"]

# day -> rows
PEOPLE = {
    2: [("nm0000001", "Christopher Nolan", 1970, None), ("nm0000002", "Leonardo DiCaprio", 1974, None),
        ("nm0000003", "Tom Hardy", 1977, None), ("nm0000004", "Quentin Tarantino", 1963, None),
        ("nm0000005", "Samuel L. Jackson", 1948, None)],
    3: [("nm0000006", "Martin Scorsese", 1942, None), ("nm0000007", "Robert De Niro", 1943, None),
        ("nm0000008", "Al Pacino", 1940, None), ("nm0000009", "Meryl Streep", 1949, None),
        ("nm0000010", "Tom Hanks", 1956, None)],
    6: [("nm0000011", "Bryan Cranston", 1956, None), ("nm0000012", "Aaron Paul", 1979, None),
        ("nm0000013", "Peter Dinklage", 1969, None), ("nm0000014", "Emilia Clarke", 1986, None),
        ("nm0000015", "Jennifer Aniston", 1969, None), ("nm0000016", "Courteney Cox", 1964, None),
        ("nm0000017", "Kit Harington", 1986, None), ("nm0000018", "Matthew Perry", 1969, 2023)],
}
# (tconst, type, title, start, end, minutes)
TITLES = {
    2: [("tt0468569", "movie", "The Dark Knight", 2008, None, 152), ("tt1375666", "movie", "Inception", 2010, None, 148),
        ("tt0110912", "movie", "Pulp Fiction", 1994, None, 154)],
    3: [("tt0111161", "movie", "The Shawshank Redemption", 1994, None, 142), ("tt0068646", "movie", "The Godfather", 1972, None, 175),
        ("tt0071562", "movie", "The Godfather Part II", 1974, None, 202)],
    5: [("tt0944947", "tvseries", "Game of Thrones", 2011, 2019, 57), ("tt0903747", "tvseries", "Breaking Bad", 2008, 2013, 49),
        ("tt0108778", "tvseries", "Friends", 1994, 2004, 22), ("tt1480055", "tvepisode", "Winter Is Coming", 2011, None, 62),
        ("tt3866862", "tvepisode", "The Long Night", 2019, None, 82), ("tt0959621", "tvepisode", "Pilot", 2008, None, 58)],
}
RATINGS = {
    2: [("tt0468569", "9.0", 2500000), ("tt1375666", "8.8", 2300000), ("tt0110912", "8.9", 2000000)],
    3: [("tt0111161", "9.3", 2700000), ("tt0068646", "9.2", 1800000), ("tt0071562", "9.0", 1300000)],
    5: [("tt0944947", "9.2", 2000000), ("tt0903747", "9.5", 1900000), ("tt0108778", "8.9", 1000000)],
}
RATING_UPDATES = {
    6: [("tt0468569", "9.1", 2550000), ("tt0903747", "9.6", 1950000), ("tt0111161", None, 2750000), ("tt0108778", "9.0", 1050000)],
}
EPISODES = [("tt1480055", "tt0944947", 1, 1), ("tt3866862", "tt0944947", 8, 3), ("tt0959621", "tt0903747", 1, 1)]
TITLE_GENRES = [
    ("tt0468569", ["Action", "Thriller", "Crime", "Drama"]), ("tt1375666", ["Action", "Sci-Fi", "Thriller"]),
    ("tt0110912", ["Crime", "Drama"]), ("tt0111161", ["Drama"]), ("tt0068646", ["Crime", "Drama"]),
    ("tt0071562", ["Crime", "Drama"]), ("tt0944947", ["Action", "Drama"]),
    ("tt0903747", ["Crime", "Drama", "Thriller"]), ("tt0108778", ["Comedy", "Romance"]),
]
CREW = [
    ("tt0468569", "nm0000001", "director"), ("tt1375666", "nm0000001", "director"), ("tt1375666", "nm0000001", "writer"),
    ("tt0110912", "nm0000004", "director"), ("tt0110912", "nm0000004", "writer"), ("tt0068646", "nm0000006", "director"),
    ("tt0071562", "nm0000006", "director"),
]
PRINCIPALS = [
    ("tt1375666", 1, "nm0000002", "actor", '["Dom Cobb"]'), ("tt1375666", 2, "nm0000003", "actor", '["Eames"]'),
    ("tt0110912", 1, "nm0000005", "actor", '["Jules Winnfield"]'), ("tt0068646", 1, "nm0000007", "actor", '["Vito Corleone"]'),
    ("tt0071562", 1, "nm0000008", "actor", '["Michael Corleone"]'), ("tt0071562", 2, "nm0000007", "actor", '["Vito Corleone"]'),
    ("tt0903747", 1, "nm0000011", "actor", '["Walter White"]'), ("tt0903747", 2, "nm0000012", "actor", '["Jesse Pinkman"]'),
    ("tt0944947", 1, "nm0000013", "actor", '["Tyrion Lannister"]'), ("tt0944947", 2, "nm0000014", "actress", '["Daenerys Targaryen"]'),
    ("tt0944947", 3, "nm0000017", "actor", '["Jon Snow"]'), ("tt0108778", 1, "nm0000015", "actress", '["Rachel Green"]'),
    ("tt0108778", 2, "nm0000016", "actress", '["Monica Geller"]'), ("tt0108778", 3, "nm0000018", "actor", '["Chandler Bing"]'),
]


def _batches(spark, inserts, updates, ddl):
    rows = [(day, "insert", *r) for day, rs in inserts.items() for r in rs]
    rows += [(day, "update", *r) for day, rs in (updates or {}).items() for r in rs]
    return spark.createDataFrame(rows, f"day int, kind string, {ddl}")


def rating_batches(spark) -> DataFrame:
    raw = _batches(spark, RATINGS, RATING_UPDATES, "tconst string, average_rating string, num_votes bigint")
    return raw.withColumn("average_rating", F.col("average_rating").cast("decimal(3,1)"))


def star(spark) -> dict[str, DataFrame]:
    """The star schema after day 6; dimension ids are looked up by name."""
    people = _batches(spark, PEOPLE, None, STAR_DDL["people"])
    titles = _batches(spark, TITLES, None, "tconst string, title_type string, primary_title string, start_year smallint, "
                                            "end_year smallint, runtime_minutes int")
    genres = spark.createDataFrame([(i, g, None) for i, g in enumerate(GENRES, 1)], STAR_DDL["genres"])
    categories = spark.createDataFrame([(i, c, None) for i, c in enumerate(CATEGORIES, 1)], STAR_DDL["categories"])
    listed = spark.createDataFrame([(t, g, i) for t, gs in TITLE_GENRES for i, g in enumerate(gs, 1)],
                                   "tconst string, genre_name string, genre_order smallint")
    cast = spark.createDataFrame([(t, o, n, c, None, ch) for t, o, n, c, ch in PRINCIPALS],
                                 "tconst string, ordering smallint, nconst string, category_name string, job string, characters string")
    return {
        "titles": fold_batches(titles, ["tconst"], "day", "kind", []).select(
            "tconst", "title_type", "primary_title", F.col("primary_title").alias("original_title"),
            F.lit(False).alias("is_adult"), "start_year", "end_year", "runtime_minutes"),
        "people": fold_batches(people, ["nconst"], "day", "kind", []),
        "ratings": fold_batches(rating_batches(spark), ["tconst"], "day", "kind", ["average_rating", "num_votes"]),
        "genres": genres,
        "categories": categories,
        "title_genres": with_dimension_id(listed, genres, "genre_id", "genre_name", "genre_name").select("tconst", "genre_id", "genre_order"),
        "title_principals": with_dimension_id(cast, categories, "category_id", "category_name", "category_name").select(
            "tconst", "ordering", "nconst", "category_id", "job", "characters"),
        "title_crew": spark.createDataFrame(CREW, STAR_DDL["title_crew"]),
        "episodes": spark.createDataFrame(EPISODES, STAR_DDL["episodes"]),
    }


def staging(spark) -> dict[str, DataFrame]:
    """The same catalogue as the seven text staging tables."""
    s = star(spark)
    genre_lists = dict((t, ",".join(g)) for t, g in TITLE_GENRES)
    lists = spark.createDataFrame(list(genre_lists.items()), "tconst string, genres string")

    def ids(role):
        people = {}
        for t, n, r in CREW:
            if r == role:
                people.setdefault(t, []).append(n)
        return {t: ",".join(ns) for t, ns in people.items()}

    directors, writers = ids("director"), ids("writer")
    crew = [(t, directors.get(t), writers.get(t)) for t in sorted({*directors, *writers})]

    def text(c):
        return F.col(c).cast("string")

    return {
        "title_basics": s["titles"].join(lists, "tconst", "left").select(
            "tconst", F.col("title_type").alias("titletype"), F.col("primary_title").alias("primarytitle"),
            F.col("original_title").alias("originaltitle"), F.lit("0").alias("isadult"), text("start_year").alias("startyear"),
            text("end_year").alias("endyear"), text("runtime_minutes").alias("runtimeminutes"), "genres"),
        "name_basics": s["people"].select(
            "nconst", F.col("primary_name").alias("primaryname"), text("birth_year").alias("birthyear"),
            text("death_year").alias("deathyear"), F.lit(None).cast("string").alias("primaryprofession"),
            F.lit(None).cast("string").alias("knownfortitles")),
        "title_ratings": s["ratings"].select("tconst", text("average_rating").alias("averagerating"), text("num_votes").alias("numvotes")),
        "title_crew": spark.createDataFrame(crew, "tconst string, directors string, writers string"),
        "title_principals": spark.createDataFrame(
            [(t, str(o), n, c, None, ch) for t, o, n, c, ch in PRINCIPALS],
            "tconst string, ordering string, nconst string, category string, job string, characters string"),
        "title_episode": s["episodes"].select(
            F.col("episode_tconst").alias("tconst"), F.col("parent_tconst").alias("parenttconst"),
            text("season_number").alias("seasonnumber"), text("episode_number").alias("episodenumber")),
        "title_akas": spark.createDataFrame(
            [], "titleid string, ordering string, title string, region string, language string, types string, "
                "attributes string, isoriginaltitle string"),
    }


