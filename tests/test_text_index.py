import random
import re

from pyspark.sql import functions as F

from marquee.operators import snapshots, text_index
from marquee.session import ensure_shared_dir, shared_path


def words(text):
    return [w for w in re.split(r"[^a-z0-9]+", (text or "").lower()) if w]


def holds(text, phrase):
    have, want = words(text), words(phrase)
    return bool(want) and any(have[i:i + len(want)] == want for i in range(len(have)))


def titles(count, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(["a", "rose", "is", "The", "red,", "day"]) for _ in range(rng.randrange(0, 12)))) for i in range(count)]
    return rows + [(9001, None), (9002, ""), (9003, "a rose is a rose is a rose"), (9004, "the " * 300)]


PHRASES = ["a rose", "ROSE  is a", "a rose is a rose", "day", "the the the", "blue", "red day", "", "?!"]


def found(spark, path, phrase):
    return sorted(r["key"] for r in text_index.phrase_keys(spark, path, phrase).collect())


def built(spark, rows):
    ensure_shared_dir(spark)
    path = shared_path(spark, "index-test")
    df = spark.createDataFrame(rows, "id long, title string")
    text_index.build_index(df, "id", "title", path, buckets=8)
    return path, df


def test_searches_equal_a_scan(spark):
    rows = titles(300, 1)
    path, _ = built(spark, rows)
    for phrase in PHRASES:
        assert found(spark, path, phrase) == sorted(i for i, t in rows if holds(t, phrase))
    scores = {r["key"]: r["score"] for r in text_index.token_scores(spark, path, "rose day rose blue").collect()}
    assert scores == {i: len({"rose", "day"} & set(words(t))) for i, t in rows if {"rose", "day"} & set(words(t))}
    counts = {r["token"]: r["df"] for r in text_index.frequencies(spark, path, ["rose", "the", "blue"]).collect()}
    assert counts == {w: sum(w in words(t) for _, t in rows) for w in ("rose", "the")}


def test_change_sets_and_merges_keep_it_current(spark):
    path, before = built(spark, titles(200, 2))
    for seed in (3, 4, 5):
        rows = titles(150 + 20 * seed, seed)
        after = spark.createDataFrame(rows, "id long, title string")
        text_index.update_index(snapshots.diff(before, after, ["id"]), "id", "title", path)
        if seed == 4:
            text_index.merge_runs(spark, path)
            assert len(text_index.live_runs(spark, path)[0]) == 1
        for phrase in ("a rose", "rose is a", "red day"):
            assert found(spark, path, phrase) == sorted(i for i, t in rows if holds(t, phrase))
        before = after


def test_a_search_reads_the_buckets_of_its_words_only(spark):
    path, _ = built(spark, titles(200, 6))
    plan = text_index.postings(spark, path, ["rose"])._jdf.queryExecution().executedPlan().toString()
    partitions = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "bucket" in partitions and "run" in partitions
    assert "PushedFilters: [IsNotNull(token), EqualTo(token,rose)]" in plan


def test_a_run_without_its_record_does_not_count(spark):
    path, _ = built(spark, titles(50, 7))
    stray = spark.createDataFrame([(1, "blue")], "id long, title string")
    placed = text_index.word_postings(stray, "id", "title")
    placed.selectExpr("*", "0 as bucket").write.partitionBy("bucket").parquet(f"{path}/postings/run=1")
    assert found(spark, path, "blue") == []


def test_words_are_put_together_in_their_text_and_shuffled_once(spark):
    rows = titles(60, 8)
    df = spark.createDataFrame(rows, "id long, title string")
    found = text_index.word_postings(df, "id", "title")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    want = {(i, w): [n for n, x in enumerate(words(t)) if x == w] for i, t in rows for w in words(t)}
    got = found.collect()
    assert len(got) == len(want) and {(r["key"], r["token"]): r["positions"] for r in got} == want


def test_texts_of_one_key_share_a_posting(spark):
    path, _ = built(spark, [(1, "a rose is"), (1, "rose a"), (None, "day"), (None, "red day"), (2, "rose")])
    got = text_index.postings(spark, path, ["rose", "day"]).collect()
    assert sorted((str(r["key"]), r["token"], r["positions"]) for r in got) == [
        ("1", "rose", [0, 1]), ("2", "rose", [0]), ("None", "day", [0, 1])]


def test_an_update_finds_its_change_set_once(spark):
    path, _ = built(spark, titles(20, 9))
    seen = spark.sparkContext.accumulator(0)

    def count(op):
        seen.add(1)
        return op

    changes = spark.createDataFrame([("insert", 100 + i, "a blue day") for i in range(30)], "op string, id long, title string")
    text_index.update_index(changes.withColumn("op", F.udf(count)("op")), "id", "title", path)
    assert seen.value == 30
    assert len(found(spark, path, "blue day")) == 30
