import catalogue_days as days
import pytest
from pyspark.sql import functions as F

from marquee.operators import documents
from marquee.plans import films


@pytest.fixture(scope="module")
def docs(spark):
    return documents.build_documents(days.staging(spark))


def test_card(spark):
    card = films.film_card_from_staging(days.staging(spark), "the dark KNIGHT").collect()
    assert len(card) == 1
    c = card[0]
    assert (c["titulo_principal"], c["año_lanzamiento"], c["duracion_minutos"]) == ("The Dark Knight", 2008, 152)
    assert c["directores"] == ["Christopher Nolan"] and c["reparto_principal"] == [] and c["otros_titulos"] == []
    assert c["rating"]["promedio"] == 9.1 and c["rating"]["votos"] == 2550000


def test_card_with_unknown_person(spark):
    staging = days.staging(spark)
    staging["name_basics"] = staging["name_basics"].filter("nconst <> 'nm0000003'")
    staging["title_akas"] = spark.createDataFrame(
        [("tt1375666", "2", "Origen", "ES", None, None, None, "0"), ("tt1375666", "1", "Inception", None, None, None, None, "1")],
        staging["title_akas"].schema)
    c = films.film_card_from_staging(staging, "inception").first()
    assert [(p["nombre_actor"], p["personajes"]) for p in c["reparto_principal"]] == [("Leonardo DiCaprio", ["Dom Cobb"]), (None, ["Eames"])]
    assert [tuple(a) for a in c["otros_titulos"]] == [("Inception", None), ("Origen", "ES")]
    assert films.film_card_from_staging(staging, "no such film").count() == 0
    assert films.film_card_from_staging(staging, "!!").count() == 0


def test_card_pages_hold_everything(spark):
    staging = days.staging(spark)
    extra = [("tt0468569", str(i), f"nm{i:07d}", "actor", None, '["X"]') for i in range(1, 58)]
    staging["title_principals"] = staging["title_principals"].unionByName(
        spark.createDataFrame(extra, staging["title_principals"].schema))
    pages = films.film_card_from_staging(staging, "dark knight", page_size=10).orderBy("page").collect()
    assert [p["page"] for p in pages] == [0, 1, 2, 3, 4, 5]
    assert [len(p["reparto_principal"]) for p in pages] == [10, 10, 10, 10, 10, 7]


def test_search(spark):
    found = {r["title"]: r for r in films.film_search_from_staging(days.staging(spark), "Godfather Shawshank").collect()}
    assert set(found) == {"The Godfather", "The Godfather Part II", "The Shawshank Redemption"}
    assert found["The Godfather Part II"]["actors"] == ["Al Pacino", "Robert De Niro"]
    assert found["The Godfather"]["directors"] == ["Martin Scorsese"]


def test_works(docs, as_rows):
    assert as_rows(films.director_works(docs["titles"], docs["people"], "Quentin Tarantino")) == [("Pulp Fiction", 1994, "movie")]
    got = films.director_works_titles(docs["titles"], docs["people"], "Christopher Nolan").collect()
    assert [r["title"] for r in got] == ["Inception", "The Dark Knight"]
    assert got[0]["genres"] == ["Action", "Sci-Fi", "Thriller"]


def test_top_rated(docs):
    got = films.top_rated(docs["titles"]).collect()
    assert [(r["titulo"], r["rating"]["average"], r["rating"]["votes"]) for r in got] == [
        ("The Shawshank Redemption", 9.3, 2750000), ("The Godfather", 9.2, 1800000), ("The Dark Knight", 9.1, 2550000),
        ("The Godfather Part II", 9.0, 1300000), ("Pulp Fiction", 8.9, 2000000), ("Inception", 8.8, 2300000)]
    details = films.top_rated_details(docs["titles"], docs["people"], n=2).collect()
    assert {r["title"]: r["directors"] for r in details} == {"The Shawshank Redemption": [], "The Godfather": ["Martin Scorsese"]}


def test_top_directors(docs, as_rows):
    assert as_rows(films.top_directors(docs["titles"], docs["people"])) == [("nm0000001", "Christopher Nolan", 2)]
    assert as_rows(films.top_directors(docs["titles"], docs["people"], n=2, films_only=True)) == [
        ("nm0000001", "Christopher Nolan", 2), ("nm0000006", "Martin Scorsese", 2)]


def test_top_actors(spark, docs, as_rows):
    got = as_rows(films.top_actors(docs["titles"], docs["people"]))
    assert len(got) == 10 and ("nm0000007", "Robert De Niro", 2) in got
    assert all(c == 1 for n, _, c in got if n != "nm0000007")
    staging = days.staging(spark)
    assert as_rows(films.top_actors_flat(staging["title_basics"], staging["title_principals"], docs["people"])) == got
    only = films.top_actors(docs["titles"], docs["people"], categories=["actor"], films_only=True)
    flat = films.top_actors_flat(staging["title_basics"], staging["title_principals"], docs["people"], categories=["actor"], films_only=True)
    assert as_rows(only) == as_rows(flat) and only.count() == 5


def test_ranking_keeps_unknown_people(docs, as_rows):
    got = films.top_directors(docs["titles"], docs["people"].filter("nconst <> 'nm0000001'"))
    assert as_rows(got) == [("nm0000001", None, 2)]


def test_documents(docs):
    titles = {r["tconst"]: r for r in docs["titles"].collect()}
    assert len(titles) == 12
    assert titles["tt1480055"]["parent_tconst"] == "tt0944947" and titles["tt1480055"]["rating"] is None
    assert titles["tt0111161"]["crew"] is None and titles["tt0111161"]["principals"] == []
    assert [p["characters"] for p in titles["tt1375666"]["principals"]] == [["Dom Cobb"], ["Eames"]]


def test_paged_documents_equal_whole_ones(spark, as_rows):
    staging = days.staging(spark)
    copies = [("tt0468569", "3", "nm0000002", "actor", "j", None)] * 23 + [
        ("tt0468569", str(i), f"nm{i}", "actor", None, None) for i in range(40)]
    cast = staging["title_principals"].unionByName(spark.createDataFrame(copies, staging["title_principals"].schema))
    base = documents.title_base(staging["title_basics"])
    whole = documents.embed_principals(base, cast)
    paged = documents.embed_principals(base, cast, page_size=5)
    flat = [c.select("tconst", F.explode("principals").alias("p")) for c in (whole, paged)]
    assert as_rows(flat[0]) == as_rows(flat[1])
    assert whole.filter("page > 0").count() == 0 and paged.filter("page = 0").count() == 12
    pages = paged.filter("tconst = 'tt0468569'").orderBy("page").select("page", "principals.ordering").collect()
    assert [p["page"] for p in pages] == list(range(8)) and pages[2]["ordering"] == [11, 12, 13, 14, 15]


def test_json_records(spark):
    df = spark.createDataFrame([("a", None, 1)], "k string, v string, n int")
    assert documents.to_json_records(df).first()["value"] == '{"k":"a","n":1}'


def test_shuffle_partitions_stay_small(spark):
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        dealt = spark.range(500_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text")).repartition("id")
        assert len(dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.max("text")).collect()) >= 4
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
