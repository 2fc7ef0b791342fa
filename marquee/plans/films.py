"""Reports over the nested documents.

Rankings aggregate, order and limit first and fetch names last, for the few rows that remain.
Every limit has a total order: equal counts or ratings are settled by the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import text as X
from marquee.operators import documents as D
from marquee.operators.skew import PAGE_SIZE, paged_lists

ACTING = ["actor", "actress"]


def _title_rows(docs: DataFrame) -> DataFrame:
    """One row per title."""
    return docs.filter(F.col("page") == 0) if "page" in docs.columns else docs


NO_NAMES = "array<string>"


def film_card(docs: dict[str, DataFrame], phrase: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """The first film whose title holds the phrase: rating, directors, cast and other titles.

    ``docs`` holds the collections titles, people and akas. The film is chosen first; all lookups start
    from its one key. Cast and other titles come in pages (of ``page_size`` orderings for the latter),
    usually one; within a page both keep their order.
    """
    titles, people = docs["titles"], docs["people"].select("nconst", "primaryName")
    film = _title_rows(titles).filter(X.phrase_match(F.col("primaryTitle"), phrase)).orderBy("tconst").limit(1)
    key = F.broadcast(film.select("tconst"))  # one row
    ids = film.select("tconst", F.col("crew.directors").alias("ids"))
    directors = _names(ids, people, "directores", few=True)

    billed = titles.join(key, "tconst", "left_semi").select("tconst", "page", F.posexplode("principals").alias("pos", "p"))
    # The cast picks its people first: only those few take part in the outer join.
    members = people.join(billed.select("p.nconst").distinct(), "nconst", "left_semi").withColumnRenamed("nconst", "_id")
    entry = F.struct("pos", F.col("primaryName").alias("nombre_actor"), F.col("p.characters").alias("personajes"))
    cast = billed.join(members, F.col("p.nconst") == F.col("_id"), "left").groupBy("tconst", "page").agg(
        F.sort_array(F.collect_list(entry)).alias("_cast"))
    other = docs["akas"].withColumnRenamed("titleId", "tconst").join(key, "tconst", "left_semi")
    akas = paged_lists(other, "tconst", F.col("ordering"), F.struct("ordering", F.col("title").alias("titulo"), "region"), "_akas", page_size,
                       heads=film)  # the film's facts stand on page 0, also where no list begins there

    lists = cast.join(akas, ["tconst", "page"], "full_outer")
    facts = film.select("tconst", "primaryTitle", "titleType", "startYear", "runtimeMinutes", "genres", "rating")
    out = facts.join(directors, "tconst", "left").join(lists, "tconst", "left")
    return out.select(
        F.col("tconst"),
        F.coalesce("page", F.lit(0)).alias("page"),
        F.col("primaryTitle").alias("titulo_principal"),
        F.col("titleType").alias("tipo"),
        F.col("startYear").alias("año_lanzamiento"),
        F.col("runtimeMinutes").alias("duracion_minutos"),
        F.col("genres").alias("generos"),
        F.struct(F.col("rating.average").alias("promedio"), F.col("rating.votes").alias("votos")).alias("rating"),
        F.coalesce("directores", F.array().cast(NO_NAMES)).alias("directores"),
        F.coalesce(
            F.transform("_cast", lambda p: F.struct(p["nombre_actor"].alias("nombre_actor"), p["personajes"].alias("personajes"))),
            F.array().cast("array<struct<nombre_actor:string,personajes:array<string>>>"),
        ).alias("reparto_principal"),
        F.coalesce(
            F.transform("_akas", lambda a: F.struct(a["titulo"].alias("titulo"), a["region"].alias("region"))),
            F.array().cast("array<struct<titulo:string,region:string>>"),
        ).alias("otros_titulos"),
    )


def _staged(staging: dict[str, DataFrame], keys: DataFrame) -> dict[str, DataFrame]:
    """Staging reduced to the titles of ``keys`` (one column, tconst), so that documents are built for those alone."""
    own = {t: staging[t].join(keys, "tconst", "left_semi") for t in (
        "title_basics", "title_ratings", "title_crew", "title_episode", "title_principals")}
    akas = staging["title_akas"].join(keys.withColumnRenamed("tconst", "titleid"), "titleid", "left_semi")
    return {**own, "title_akas": akas, "name_basics": staging["name_basics"]}


def film_card_from_staging(
    staging: dict[str, DataFrame], phrase: str, characters: str = "json", page_size: int = PAGE_SIZE
) -> DataFrame:
    """The same card where no documents are stored: those of the one film are built on the way."""
    held = staging["title_basics"].filter(X.phrase_match(F.col("primarytitle"), phrase)).filter("tconst is not null")
    key = F.broadcast(held.select("tconst").orderBy("tconst").limit(1))  # one row
    return film_card(D.build_documents(_staged(staging, key), characters, page_size), phrase, page_size)


def _names(lists: DataFrame, people: DataFrame, out: str, few: bool = False) -> DataFrame:
    """Names of the known people in an id list (columns tconst, ids), each person once, in list order.

    The list is unfolded and joined by equality; it is one source cell, so refolding it is bounded.
    ``few`` says that ``lists`` comes from a limit, so its ids are sent to the people, not shuffled.
    """
    one = lists.select("tconst", F.posexplode(F.array_distinct("ids")).alias("pos", "nconst"))
    named = people.select("nconst", "primaryName").join(F.broadcast(one) if few else one, "nconst")
    ordered = F.sort_array(F.collect_list(F.struct("pos", "primaryName")))
    return named.groupBy("tconst").agg(ordered.alias("_n")).select(
        "tconst", F.transform("_n", lambda x: x["primaryName"]).alias(out)
    )


def film_search(docs: dict[str, DataFrame], query: str) -> DataFrame:
    """Every title holding a word of the query, with rating, director and cast names.

    Cast names come in pages like the cast itself, each person once per page, in billing order.
    """
    people = docs["people"].select("nconst", "primaryName")
    hits = docs["titles"].withColumn("score", X.token_score(F.col("primaryTitle"), query)).filter("score > 0")
    directors = _names(_title_rows(hits).select("tconst", F.col("crew.directors").alias("ids")), people, "directors")
    billed = hits.select("tconst", "page", F.posexplode("principals").alias("pos", "p")).groupBy(
        "tconst", "page", F.col("p.nconst").alias("nconst")).agg(F.min("pos").alias("pos"))
    cast = billed.join(people, "nconst").groupBy("tconst", "page").agg(
        F.sort_array(F.collect_list(F.struct("pos", "primaryName"))).alias("_a"))
    out = hits.join(directors, "tconst", "left").join(cast, ["tconst", "page"], "left")
    none = F.array().cast(NO_NAMES)
    return out.select(
        "tconst", "page", F.col("primaryTitle").alias("title"),
        F.col("startYear").alias("year"), F.col("rating.average").alias("rating"), F.col("rating.votes").alias("votes"),
        F.coalesce("directors", none).alias("directors"),
        F.coalesce(F.transform("_a", lambda x: x["primaryName"]), none).alias("actors"),
        "genres", "score",
    )


def film_search_from_staging(staging: dict[str, DataFrame], query: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """The same search where no documents are stored: those of the found titles are built on the way."""
    found = staging["title_basics"].filter(X.token_score(F.col("primarytitle"), query) > 0).select("tconst").distinct()
    return film_search(D.build_documents(_staged(staging, found), page_size=page_size), query)


def director_works(titles: DataFrame, people: DataFrame, name: str) -> DataFrame:
    """All works, of any type, of people with that name: one row per person and title."""
    persons = people.filter(F.col("primaryName") == F.lit(name)).select("nconst")
    credits = _title_rows(titles).select(
        "primaryTitle", "startYear", "titleType", F.explode(F.array_distinct("crew.directors")).alias("nconst")
    )
    return credits.join(persons, "nconst").select(
        F.col("primaryTitle").alias("titulo"), F.col("startYear").alias("año"), F.col("titleType").alias("tipo")
    )


def director_works_titles(titles: DataFrame, people: DataFrame, name: str, ordered: bool = True) -> DataFrame:
    """The same from the title side, each title once, with rating and genres, newest first."""
    persons = people.filter(F.col("primaryName") == F.lit(name)).select("nconst")
    rows = _title_rows(titles)
    hits = rows.select("tconst", F.explode("crew.directors").alias("nconst")).join(persons, "nconst", "left_semi")
    out = rows.join(hits.select("tconst").distinct(), "tconst", "left_semi").select(
        "tconst", F.col("primaryTitle").alias("title"), F.col("startYear").alias("year"),
        F.col("rating.average").alias("rating"), "genres",
    )
    return out.orderBy(F.desc_nulls_last("year"), "tconst") if ordered else out


def _top_rated_rows(titles: DataFrame, min_votes: int, n: int) -> DataFrame:
    good = _title_rows(titles).filter((F.col("titleType") == "movie") & (F.col("rating.votes") >= min_votes))
    return good.orderBy(F.desc("rating.average"), F.desc("rating.votes"), "tconst").limit(n)


def top_rated(titles: DataFrame, min_votes: int = 200_000, n: int = 10) -> DataFrame:
    """Best rated films with enough votes."""
    return _top_rated_rows(titles, min_votes, n).select(
        "tconst", F.col("primaryTitle").alias("titulo"), "rating", F.col("startYear").alias("año")
    )


def top_rated_details(titles: DataFrame, people: DataFrame, min_votes: int = 100_000, n: int = 10) -> DataFrame:
    """Best rated films with directors and genres; directors are looked up for the ``n`` rows only."""
    top = _top_rated_rows(titles, min_votes, n)
    names = _names(top.select("tconst", F.col("crew.directors").alias("ids")), people, "directors", few=True)
    return top.join(F.broadcast(names), "tconst", "left").select(
        "tconst", F.col("primaryTitle").alias("title"), F.col("startYear").alias("year"),
        F.col("rating.average").alias("rating"), F.col("rating.votes").alias("votes"),
        F.coalesce("directors", F.array().cast("array<string>")).alias("directors"), "genres",
    )


def name_late(counts: DataFrame, people: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Order and limit the counts, then fetch the names of the ``n`` ids left.

    Both uses of the ranking share one shuffle of the counts, and people are read without one.
    """
    top = counts.orderBy(*order).limit(n)
    named = people.select("nconst", "primaryName").join(F.broadcast(top.select("nconst")), "nconst", "left_semi")
    return top.join(named, "nconst", "left")


def top_directors(titles: DataFrame, people: DataFrame, n: int = 1, films_only: bool = False) -> DataFrame:
    """Directors with the most works."""
    rows = _title_rows(titles)
    if films_only:
        rows = rows.filter(F.col("titleType") == "movie")
    listed = rows.filter(F.size("crew.directors") > 0).select(F.explode("crew.directors").alias("nconst"))
    counts = listed.groupBy("nconst").agg(F.count(F.lit(1)).alias("cantidad"))
    top = name_late(counts, people, n, [F.desc("cantidad"), F.asc("nconst")])
    return top.select("nconst", F.col("primaryName").alias("nombre_director"), F.col("cantidad").alias("cantidad_obras"))


def top_actors(
    titles: DataFrame, people: DataFrame, n: int = 10, categories: list[str] | None = None, films_only: bool = False
) -> DataFrame:
    """People with the most cast entries. Every page of a title counts."""
    wanted = categories or ACTING
    rows = titles.filter(F.col("titleType") == "movie") if films_only else titles
    rows = rows.filter(F.exists("principals", lambda p: p["category"].isin(*wanted)))
    entries = rows.select(F.explode("principals").alias("p")).filter(F.col("p.category").isin(*wanted))
    counts = entries.groupBy(F.col("p.nconst").alias("nconst")).agg(F.count(F.lit(1)).alias("cantidad"))
    top = name_late(counts, people, n, [F.desc("cantidad"), F.asc("nconst")])
    return top.select("nconst", F.col("primaryName").alias("nombre_actor"), F.col("cantidad").alias("cantidad_apariciones"))


def top_actors_flat(
    basics: DataFrame, principals: DataFrame, people: DataFrame, n: int = 10, categories: list[str] | None = None,
    films_only: bool = False,
) -> DataFrame:
    """The same ranking straight from staging, for when no documents are stored: cast rows are
    filtered and counted without building arrays; a title filter costs one semi join."""
    wanted = categories or ACTING
    entries = principals.filter(F.col("category").isin(*wanted)).select("tconst", "nconst")
    titles = basics.filter(F.col("titletype") == "movie") if films_only else basics
    entries = entries.join(titles.select("tconst"), "tconst", "left_semi")
    counts = entries.groupBy("nconst").agg(F.count(F.lit(1)).alias("cantidad"))
    top = name_late(counts, people, n, [F.desc("cantidad"), F.asc("nconst")])
    return top.select("nconst", F.col("primaryName").alias("nombre_actor"), F.col("cantidad").alias("cantidad_apariciones"))
