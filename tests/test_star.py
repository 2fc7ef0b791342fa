import catalogue_days as days
import pytest
from pyspark.errors import PySparkException

from marquee.operators import clean, integrity, normalize
from marquee.operators.upsert import one_per_key
from marquee.plans import directors


def test_counts_after_six_days(spark):
    got = {r["tabla"]: r["total"] for r in integrity.table_counts(days.star(spark)).collect()}
    assert got == {"titles": 12, "people": 18, "ratings": 9, "genres": 10, "categories": 10, "title_genres": 21,
                   "title_principals": 14, "title_crew": 7, "episodes": 3}


def test_staging_rebuilds_the_star(spark, as_rows):
    built, want = normalize.build_star(days.staging(spark)), days.star(spark)
    for name in ("titles", "people", "ratings", "title_crew", "episodes"):
        assert as_rows(built[name]) == as_rows(want[name]), name
    named = built["title_genres"].join(built["genres"], "genre_id").select("tconst", "genre_order", "genre_name")
    expected = want["title_genres"].join(want["genres"], "genre_id").select("tconst", "genre_order", "genre_name")
    assert as_rows(named) == as_rows(expected)
    assert built["title_principals"].count() == 14


def test_star_is_sound(spark):
    assert integrity.check_star(days.star(spark)).collect() == []


def test_director_info(spark, as_rows):
    assert as_rows(directors.director_info(days.star(spark), "Christopher Nolan")) == [("nm0000001", "Christopher Nolan", 1970, None, 2)]
    assert directors.director_info(days.star(spark), "Tom Hanks").count() == 0


def test_director_movies(spark):
    got = [tuple(r) for r in directors.director_movies(days.star(spark), "Christopher Nolan").collect()]
    assert [(g[0], g[1], g[2], g[3], float(g[4]), g[5], g[6]) for g in got] == [
        ("tt1375666", "Inception", 2010, 148, 8.8, 2300000, "Action, Sci-Fi, Thriller"),
        ("tt0468569", "The Dark Knight", 2008, 152, 9.1, 2550000, "Action, Thriller, Crime, Drama"),
    ]


def test_namesakes_and_unknown_years(spark):
    star = days.star(spark)
    star["people"] = star["people"].unionByName(
        spark.createDataFrame([("nm9", "Christopher Nolan", None, None)], star["people"].schema))
    star["title_crew"] = star["title_crew"].unionByName(
        spark.createDataFrame([("tt1375666", "nm9", "director"), ("tt9", "nm9", "director")], star["title_crew"].schema))
    star["titles"] = star["titles"].unionByName(spark.createDataFrame(
        [("tt9", "movie", "Untimed", "Untimed", False, None, None, None), ], star["titles"].schema))
    assert directors.director_info(star, "Christopher Nolan").count() == 2
    films = directors.director_movies(star, "Christopher Nolan").collect()
    # Unknown years come first; a film reached through two people lists its genres twice.
    assert [f["tconst"] for f in films] == ["tt9", "tt1375666", "tt0468569"]
    assert films[0]["genres"] is None
    assert films[1]["genres"] == "Action, Action, Sci-Fi, Sci-Fi, Thriller, Thriller"


def test_sql_functions(spark, as_rows):
    star = days.star(spark)
    directors.register_views(spark, star)
    directors.register_functions(spark)
    got = spark.sql("SELECT * FROM get_director_info('Christopher Nolan')")
    assert as_rows(got) == as_rows(directors.director_info(star, "Christopher Nolan"))
    got = spark.sql("SELECT * FROM get_director_movies('Christopher Nolan')")
    assert as_rows(got) == as_rows(directors.director_movies(star, "Christopher Nolan"))


def basics(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (
        "tconst", "titletype", "primarytitle", "originaltitle", "isadult", "startyear", "endyear", "runtimeminutes", "genres")))


def test_title_types(spark, as_rows):
    raw = basics(spark, [(k, t, "x", "x", a, "1994", None, "n/a", None) for k, t, a in
                         [("tt1", "tvMovie", "1"), ("tt2", "Movie", "0"), ("tt3", "tvSeries", None), ("tt4", "videoGame", "0"),
                          ("", "movie", "0"), (None, "movie", "0")]])
    assert as_rows(clean.clean_titles(raw), "tconst", "title_type", "is_adult") == [("tt2", "movie", False), ("tt3", "tvseries", None)]
    assert as_rows(clean.clean_titles(raw, keep_all_types=True), "tconst", "title_type") == [
        ("tt1", "tvMovie"), ("tt2", "movie"), ("tt3", "tvseries")]


def test_genre_lists(spark, as_rows):
    raw = basics(spark, [("tt1", "movie", "x", "x", "0", None, None, None, "B,A,A"), ("tt2", "movie", "x", "x", "0", None, None, None, ""),
                         ("tt3", "movie", "x", "x", "0", None, None, None, "\\N"), ("tt4", "videoGame", "x", "x", "0", None, None, None, "C")])
    genres = normalize.genres_dim(raw)
    assert as_rows(genres) == [(1, "A"), (2, "B"), (3, "C")]
    assert as_rows(normalize.title_genres(raw, genres, clean.clean_titles(raw))) == [("tt1", 1, 2), ("tt1", 1, 3), ("tt1", 2, 1)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dimension_of_any_size(spark, ansi):
    raw = spark.range(40000).selectExpr("concat('c', id) as category")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        dim = normalize.categories_dim(raw)
        assert dim.count() == 40000
        names = [r["category_name"] for r in dim.orderBy("category_id").collect()]
        assert names == sorted(names) and dim.agg({"category_id": "max"}).first()[0] == 40000
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_repeated_keys_raise(spark):
    for table, build in (("title_basics", clean.clean_titles), ("name_basics", clean.clean_people)):
        twice = days.staging(spark)[table]
        with pytest.raises(PySparkException, match="duplicate key"):
            build(twice.unionByName(twice)).count()
    star = days.star(spark)
    ratings = days.staging(spark)["title_ratings"]
    with pytest.raises(PySparkException, match="duplicate key"):
        clean.clean_ratings(ratings.unionByName(ratings), star["titles"]).select("tconst").collect()


def test_first_episode_row_wins(spark, as_rows):
    titles = spark.createDataFrame([("tt1",), ("tt2",)], "tconst string")
    raw = spark.createDataFrame([("tt1", "tt2", "2", "1"), ("tt1", "tt2", "1", "9"), ("tt1", "tt7", "1", "1")],
                                "tconst string, parenttconst string, seasonnumber string, episodenumber string")
    assert as_rows(normalize.episodes(raw, titles)) == [("tt1", "tt2", 1, 9)]


def test_key_helpers(spark, as_rows):
    df = spark.createDataFrame([(k,) for k in ("a", "b", "c", "d")], "k string")
    assert as_rows(clean.key_range(df, "k", "a", "c")) == [("b",), ("c",)]
    assert as_rows(clean.key_page(df, "k", "a", 2)) == [("b",), ("c",)]
    assert clean.range_partition(df, "k", 3).count() == 4


def test_keys_are_checked_without_sorting_whole_rows_twice(spark, as_rows):
    rows = spark.createDataFrame([("a", "x", 1), ("b", None, 2)], "k string, t string, n int")
    checked = one_per_key(rows, ["k"])
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Sort [") == 1
    assert as_rows(checked) == as_rows(rows)
    with pytest.raises(PySparkException, match="duplicate key on k: a"):
        one_per_key(rows.unionByName(rows.limit(1)), ["k"]).select("k").count()
