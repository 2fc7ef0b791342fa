import catalogue_days as days

from marquee.operators import integrity as I
from marquee.schemas import FOREIGN_KEYS


def broken(spark):
    star = days.star(spark)
    star["ratings"] = star["ratings"].unionByName(spark.sql("select 'ttX' as tconst, cast(1 as decimal(3,1)) as average_rating, 1L as num_votes"))
    star["titles"] = star["titles"].unionByName(star["titles"].filter("tconst = 'tt0068646'")).unionByName(
        spark.createDataFrame([("ttN", "opera", None, None, False, None, None, None)], star["titles"].schema))
    return star


def test_check_star(spark, as_rows):
    got = as_rows(I.check_star(broken(spark)))
    assert got == sorted([("allowed", "titles", "title_type", 1), ("reference", "ratings", "tconst", 1),
                          ("required", "titles", "primary_title", 1), ("unique", "titles", "tconst", 2)], key=str)


def test_reports(spark, as_rows):
    star = broken(spark)
    assert as_rows(I.pk_duplicates(star["titles"], ["tconst"])) == [("tt0068646", 2)]
    assert as_rows(I.fk_report(star, FOREIGN_KEYS)) == [("ratings", "tconst", "ttX", 1)]
    assert as_rows(I.enum_violations(star["titles"], "title_type", ["movie", "tvseries", "tvepisode"])) == [("opera", 1)]
    limits = [("primary_title", 15), ("tconst", None)]
    assert as_rows(I.length_violations(star["titles"], limits)) == [("primary_title", 15, 3, 24)]
    assert I.too_long(star["titles"], limits).count() == 3


def test_cascade(spark):
    star = days.star(spark)
    gone_t = spark.createDataFrame([("tt0944947",)], "tconst string")
    gone_p = spark.createDataFrame([("nm0000001",), ("nm0000007",)], "nconst string")
    left = {r["tabla"]: r["total"] for r in I.table_counts(I.cascade_delete(star, gone_t, gone_p)).collect()}
    # The series takes its two episodes' links (as parent) but not the episode titles.
    assert left == {"titles": 11, "people": 16, "ratings": 8, "genres": 10, "categories": 10, "title_genres": 19,
                    "title_principals": 9, "title_crew": 4, "episodes": 1}
