import catalogue_days as days
import pytest
from pyspark.sql import functions as F

from marquee.operators import upsert as U


def table(spark, rows, ddl="k string, a int, b string"):
    return spark.createDataFrame(rows, ddl)


OLD = [("x", 1, "one"), ("y", 2, None), ("z", None, "three")]


def test_replace(spark, as_rows):
    got = U.upsert_replace(table(spark, OLD), table(spark, [("y", 9, "new"), ("w", 0, None)]), ["k"])
    assert as_rows(got) == [("w", 0, None), ("x", 1, "one"), ("y", 9, "new"), ("z", None, "three")]


def test_duplicate_key_in_a_batch_raises(spark):
    with pytest.raises(U.DuplicateKeyError, match="y"):
        U.upsert_replace(table(spark, OLD), table(spark, [("y", 1, None), ("y", 2, None)]), ["k"])


def test_insert_ignore(spark, as_rows):
    new = table(spark, [("x", 5, "no"), ("v", 7, "b"), ("v", 6, "a")])
    once = U.insert_ignore(table(spark, OLD), new, ["k"], ["a"])
    assert as_rows(once, "k", "a") == [("v", 6), ("x", 1), ("y", 2), ("z", None)]
    assert as_rows(U.insert_ignore(once, new, ["k"], ["a"])) == as_rows(once)


def test_sparse(spark, as_rows):
    new = table(spark, [(1, "y", None, "set"), (2, "y", 8, None), (3, "w", None, "w")], "i int, k string, a int, b string")
    once = U.upsert_sparse(table(spark, OLD), new, ["k"], ["i"])
    assert as_rows(once) == [("w", None, "w"), ("x", 1, "one"), ("y", 8, "set"), ("z", None, "three")]
    assert as_rows(U.upsert_sparse(once, new, ["k"], ["i"])) == as_rows(once)


def test_update_matched(spark, as_rows):
    changes = table(spark, [("x", None), ("q", 4)], "k string, a int")
    got = U.update_matched(table(spark, OLD), changes, ["k"], ["a"])
    assert as_rows(got) == [("x", None, "one"), ("y", 2, None), ("z", None, "three")]


def test_collapse_keeps_earlier_value(spark, as_rows):
    rows = table(spark, [("t", 1, "director", "lead"), ("t", 2, "actor", None)], "k string, ordering int, category string, job string")
    assert as_rows(U.collapse_last_non_null(rows, ["k"], ["ordering"])) == [("t", 2, "actor", "lead")]


def test_rating_batches(spark, as_rows):
    folded = U.fold_batches(days.rating_batches(spark), ["tconst"], "day", "kind", ["average_rating", "num_votes"])
    got = {r["tconst"]: (float(r["average_rating"]), r["num_votes"]) for r in folded.collect()}
    assert got["tt0111161"] == (9.3, 2750000) and got["tt0468569"] == (9.1, 2550000) and len(got) == 9
    again = days.rating_batches(spark).unionByName(days.rating_batches(spark))
    assert as_rows(U.fold_batches(again, ["tconst"], "day", "kind", ["average_rating", "num_votes"])) == as_rows(folded)


def test_update_before_insert_does_nothing(spark, as_rows):
    rows = table(spark, [(1, "update", "x", 5), (2, "insert", "x", 1), (3, "update", "y", 9), (2, "insert", "x", 0)],
                 "batch int, kind string, k string, v int")
    assert as_rows(U.fold_batches(rows, ["k"], "batch", "kind", ["v"])) == [("x", 0)]


def test_audit(spark):
    t0, t1 = F.lit("2001-01-01").cast("timestamp"), F.lit("2002-01-01").cast("timestamp")
    old = table(spark, OLD).withColumn("created_at", t0).withColumn("updated_at", t0)
    new = table(spark, [("x", 1, "one"), ("y", 3, None), ("w", 0, None)])
    got = {r["k"]: (r["created_at"].year, r["updated_at"].year) for r in U.stamp_audit(old, new, ["k"], t1).collect()}
    assert got == {"x": (2001, 2001), "y": (2001, 2002), "w": (2002, 2002), "z": (2001, 2001)}


def test_hot_key_collapses_map_side(spark):
    hot = spark.range(30000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) as k", "cast(id as int) as i", "cast(id as string) as v")
    got = U.collapse_last_non_null(hot, ["k"], ["i"]).filter("k = 'hot'").first()
    assert got["i"] == 29997 and got["v"] == "29997"
