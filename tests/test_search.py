import pytest

from marquee.operators import search as SE

TITLES = ["The Dark Knight", "Dark Knights", "A knight, dark", "The  DARK-knight rises", "Amélie", "100% Wolf", "1000 Wolf", "", None]


@pytest.fixture
def titles(spark):
    return spark.createDataFrame(list(enumerate(TITLES)), "id int, title string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_phrase(titles):
    assert ids(SE.phrase_search(titles, "title", "dark knight")) == [0, 3]
    assert ids(SE.phrase_search(titles, "title", "amelie")) == [4]
    assert ids(SE.phrase_search(titles, "title", "!!")) == []


def test_tokens(titles):
    got = {r["id"]: r["score"] for r in SE.token_search(titles, "title", "dark KNIGHT dark").collect()}
    assert got == {0: 2, 1: 1, 2: 2, 3: 2}


def test_ilike(titles):
    assert ids(SE.ilike_search(titles, "title", "0% w")) == [5]
    assert ids(SE.ilike_search(titles, "title", "DARK")) == [0, 1, 2, 3]


def test_similar_terms_match_pairwise_similarity(spark, titles):
    terms = spark.createDataFrame([("dark knight",), ("wolf",), ("dark knight",)], "t string")
    got = {(r["id"], r["term"]): r["similarity"] for r in SE.similar_to_terms(titles, "id", "title", terms, "t", 0.3).collect()}
    want = {}
    for term in ("dark knight", "wolf"):
        for r in SE.similar(titles, "title", term, 0.3).collect():
            want[(r["id"], term)] = r["similarity"]
    assert got == pytest.approx(want) and got
    with pytest.raises(ValueError):
        SE.similar_to_terms(titles, "id", "title", terms, "t", 0)


def test_aka(spark):
    titles = spark.createDataFrame([("tt1", "One"), ("tt2", "Two")], "tconst string, primaryTitle string")
    akas = spark.createDataFrame([("tt1", "Uno"), ("tt1", "Uno"), ("tt2", "Dos")], "titleId string, title string")
    assert [r["tconst"] for r in SE.aka_lookup(titles, akas, "Uno").collect()] == ["tt1"]
