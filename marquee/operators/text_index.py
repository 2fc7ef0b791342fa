"""A stored word index: search that reads the postings of the words asked for, not the texts.

The index lies in one folder. ``postings/run=<n>/bucket=<b>`` holds one row per word and row of the table, with the
places of the word, sorted by word; ``changes/run=<n>`` the change set an update was made from, ``gone/run=<n>`` the
keys whose earlier postings it replaces; ``runs/run=<n>`` is written last and makes the run count. A build and a merge
write a base run, an update from a change set a further run. A search prunes to the buckets of its words and filters
the row groups by word; a frequent word fills several files, so no row, task or file holds a whole posting list.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions import text as X
from marquee.functions.columns import let
from marquee.sources.tsv import path_exists

BUCKETS = 64


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def word_postings(rows: DataFrame, key: str, column: str) -> DataFrame:
    """(key, token, positions): the places of each word of a text, from 0, in the words of search terms.

    The words are sorted and put together within their text, so nothing is shuffled: a row for each word of each text.
    """
    words = F.filter(F.split(X.normalise(F.col(column)), " "), lambda w: w != "")
    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("token"), i.alias("at"))))

    def firsts(ps: Column) -> Column:
        """Where in the sorted places each word begins."""
        new = F.transform(ps, lambda p, i: F.when((i == 0) | (p["token"] != F.get(ps, i - 1)["token"]), i))
        return F.filter(new, lambda i: i.isNotNull())

    def grouped(ps: Column, begins: Column) -> Column:
        def of(begin: Column, n: Column) -> Column:
            last = F.coalesce(F.get(begins, n + 1), F.size(ps)) - 1
            places = F.transform(F.sequence(begin, last), lambda i: F.get(ps, i)["at"])
            return F.struct(F.get(ps, begin)["token"].alias("token"), places.alias("positions"))

        return F.transform(begins, of)

    found = let(placed, lambda ps: let(firsts(ps), lambda begins: grouped(ps, begins)))
    return rows.select(F.col(key).alias("key"), F.explode(found).alias("p")).select("key", "p.token", "p.positions")


def _dealt(postings: DataFrame, buckets: int) -> DataFrame:
    """Postings with ``bucket`` and ``part``, dealt by both: a bucket, and a frequent word in it, lies in many tasks.

    Where a row goes follows from its word and key alone, so no texts are read beforehand to find ranges.
    """
    parts = -(-4 * int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets)
    placed = postings.withColumn("bucket", _bucket(F.col("token"), buckets)).withColumn("part", _bucket(F.col("key"), parts))
    return placed.repartition("bucket", "part")


def _merged(dealt: DataFrame) -> DataFrame:
    """One row for each word and key, also where several texts have one key: their places together, sorted."""
    same = Window.partitionBy("bucket", "token", "part", "key").orderBy("positions")
    every = F.collect_list("positions").over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    numbered = dealt.select("*", every.alias("every"), F.row_number().over(same).alias("n")).where("n = 1")
    return numbered.withColumn("positions", F.sort_array(F.flatten("every"))).drop("every", "n")


def _write_run(
    postings: DataFrame, gone: DataFrame | None, path: str, run: int, base: bool, buckets: int, fresh: bool = True
) -> int:
    """``fresh`` postings come from texts, and texts of one key are still apart."""
    spark = postings.sparkSession
    dealt = _dealt(postings, buckets)
    (_merged(dealt) if fresh else dealt).sortWithinPartitions("bucket", "token", "part", "key").drop("part").write.mode(
        "overwrite").partitionBy("bucket").parquet(f"{path}/postings/run={run}")
    if gone is not None:
        gone.select("key").distinct().write.mode("overwrite").parquet(f"{path}/gone/run={run}")
    spark.createDataFrame([(base, buckets)], "base boolean, buckets int").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/runs/run={run}")
    return run


def live_runs(spark: SparkSession, path: str) -> tuple[list[int], int]:
    """The last base run and those after it, and how many buckets they have. Merges keep the list short."""
    if not path_exists(spark, f"{path}/runs/run=*"):
        return [], BUCKETS
    runs = spark.read.parquet(f"{path}/runs").select("run", "base", "buckets").collect()
    first = max((r["run"] for r in runs if r["base"]), default=0)
    return sorted(r["run"] for r in runs if r["run"] >= first), next(r["buckets"] for r in runs if r["run"] == first)


def build_index(rows: DataFrame, key: str, column: str, path: str, buckets: int = BUCKETS) -> int:
    """Index the whole table anew as a base run; earlier runs no longer count. ``key`` is unique."""
    runs, _ = live_runs(rows.sparkSession, path)
    return _write_run(word_postings(rows, key, column), None, path, max(runs, default=-1) + 1, True, buckets)


def update_index(changes: DataFrame, key: str, column: str, path: str) -> int:
    """Add one change set (op, key, column): insert and update bring new postings, update and delete retire old ones.

    The run is numbered after the last that counts, so a failed update is written again under the same number.
    """
    spark = changes.sparkSession
    runs, buckets = live_runs(spark, path)
    run = max(runs) + 1
    # The change set is read twice, for the postings and for the keys; it is found once.
    changes = changes.select("op", F.col(key).alias("key"), F.col(column).alias("text"))
    changes.write.mode("overwrite").parquet(f"{path}/changes/run={run}")
    kept = spark.read.schema(changes.schema).parquet(f"{path}/changes/run={run}")
    return _write_run(word_postings(kept.where("op <> 'delete'"), "key", "text"), kept, path, run, False, buckets)


def _live(spark: SparkSession, path: str, runs: list[int], postings: DataFrame) -> DataFrame:
    """The postings that no later run has retired."""
    later = [r for r in runs[1:] if path_exists(spark, f"{path}/gone/run={r}")]
    if not later:
        return postings
    parts = [spark.read.parquet(f"{path}/gone/run={r}").select("key", F.lit(r).alias("gone")) for r in later]
    gone = reduce(DataFrame.unionByName, parts).groupBy("key").agg(F.max("gone").alias("gone"))
    return postings.join(gone, "key", "left").where("gone is null or run >= gone").drop("gone")


def merge_runs(spark: SparkSession, path: str) -> int:
    """All live postings as one base run."""
    runs, buckets = live_runs(spark, path)
    stored = spark.read.parquet(f"{path}/postings").where(F.col("run").isin(runs))
    merged = _live(spark, path, runs, stored).select("key", "token", "positions")
    return _write_run(merged, None, path, max(runs) + 1, True, buckets, fresh=False)


def postings(spark: SparkSession, path: str, words: list[str]) -> DataFrame:
    """(key, token, positions) of the words asked for: only their buckets are read."""
    runs, buckets = live_runs(spark, path)
    names = spark.createDataFrame([(w,) for w in words], "token string")
    wanted = sorted({r["b"] for r in names.select(_bucket(F.col("token"), buckets).alias("b")).collect()})
    stored = spark.read.parquet(f"{path}/postings").where(
        F.col("run").isin(runs) & F.col("bucket").isin(wanted) & F.col("token").isin(words))
    return _live(spark, path, runs, stored).select("key", "token", "positions")


def frequencies(spark: SparkSession, path: str, words: list[str]) -> DataFrame:
    """(token, df): in how many rows each word stands."""
    return postings(spark, path, words).groupBy("token").agg(F.count("*").alias("df"))


def phrase_keys(spark: SparkSession, path: str, phrase: str) -> DataFrame:
    """The keys of the rows that hold the phrase as whole words, each once: its words stand at places one after another.

    Each place of a word says where the phrase would start; a start that every word of the phrase names is a hit.
    """
    words = X.normalise_term(phrase).split()
    if not words:
        return postings(spark, path, [""]).select("key").limit(0)
    places = {w: [i for i, other in enumerate(words) if other == w] for w in words}
    at = F.create_map(*[c for w, ks in places.items() for c in (F.lit(w), F.array(*[F.lit(k) for k in ks]))])
    starts = F.flatten(F.transform("positions", lambda p: F.transform(F.element_at(at, F.col("token")), lambda k: p - k)))
    named = postings(spark, path, sorted(places)).select("key", F.explode(starts).alias("start"))
    return named.groupBy("key", "start").agg(F.count("*").alias("n")).where(F.col("n") == len(words)).select("key").distinct()


def token_scores(spark: SparkSession, path: str, query: str) -> DataFrame:
    """(key, score): how many distinct words of the query each row holds, for those that hold any."""
    words = sorted(set(re.split(" +", X.normalise_term(query)))) if X.normalise_term(query) else [""]
    return postings(spark, path, words).groupBy("key").agg(F.count("*").alias("score"))
