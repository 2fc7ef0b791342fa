import random

import catalogue_days as days
import pytest
from pyspark.sql import functions as F

from test_backups import snapshots

from marquee.operators import backups as B
from marquee.operators import documents
from marquee.operators import snapshots as SN
from marquee.operators.ordered import _sliced, within
from marquee.operators.skew import paged_lists
from marquee.plans import films


def brute(rows):
    out = []
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for g, rs in groups.items():
        rs = sorted(rs, key=lambda r: (r[1], r[2]))
        for i, r in enumerate(rs):
            prev = next((x[3] for x in reversed(rs[:i]) if x[3] is not None), None)
            nxt = next((x[3] for x in rs[i + 1:] if x[3] is not None), None)
            out.append((*r, prev, nxt, i + 1))
    return sorted(out, key=str)


@pytest.mark.parametrize("slices", [None, 1, 9])
@pytest.mark.parametrize("kind", ["number", "timestamp", "timestamp_ntz"])
def test_within_equals_brute_force(spark, as_rows, slices, kind):
    rnd = random.Random(7)
    # One group holds most rows, and a null group exists.
    rows = [(rnd.choice(["hot", "hot", "hot", "a", "b", None]), rnd.randrange(60), i, rnd.choice([None, f"v{i}"])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, t bigint, i int, v string")
    if kind != "number":
        df = df.withColumn("t", F.timestamp_seconds("t").cast(kind))
    got = within(df, ["g"], ["t", "i"], previous={"p": F.col("v")}, following={"n": F.col("v")}, number="k", slices=slices)
    if kind != "number":
        got = got.withColumn("t", F.unix_timestamp(F.col("t").cast("timestamp")))
    assert as_rows(got) == brute(rows)


def test_within_without_groups(spark, as_rows):
    rows = [(None, i % 50, i, None) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, t bigint, i int, v string")
    whole, cut = (within(df, [], ["t", "i"], number="k", slices=n) for n in (1, 20))
    assert as_rows(whole) == as_rows(cut) and whole.agg(F.max("k")).first()[0] == 200


def test_one_first_value_is_cut_too(spark):
    df = spark.range(4000).selectExpr("'g' as g", "7L as t", "id as i")
    base = within(df, ["g"], ["t", "i"], number="k", slices=10)
    assert [r["k"] for r in base.orderBy("i").collect()] == list(range(1, 4001))
    sizes = _sliced(df, ["g"], ["t", "i"], 10).groupBy("_slice").count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 1200


def test_nothing_runs_before_use(spark):
    tracker = spark.sparkContext.statusTracker()
    group = f"lazy-{id(spark)}"
    spark.sparkContext.setJobGroup(group, "plans only")
    df = spark.range(100).selectExpr("id % 3 as g", "id as i")
    within(df, ["g"], ["i"], previous={"p": F.col("i")}, number="k")
    paged_lists(df, "g", F.col("i"), F.struct("i"), "l", 7)
    films.film_card(documents.build_documents(days.staging(spark)), "dark")
    B.retention(snapshots(spark))
    SN.restore_chain(snapshots(spark))
    assert tracker.getJobIdsForGroup(group) == []
    spark.sparkContext.setJobGroup("tests", "tests")


def test_pages_follow_the_ordering(spark):
    rows = [("hot", i) for i in range(1, 101)] + [("hot", 7), ("cold", 3), ("cold", None), ("cold", -2)]
    df = spark.createDataFrame(rows, "k string, o int").repartition(5)
    heads = spark.createDataFrame([("hot",), ("bare",)], "k string")
    got = {(r["k"], r["page"]): [e["o"] for e in r["vs"]] for r in paged_lists(
        df, "k", F.col("o"), F.struct("o"), "vs", 10, heads).collect()}
    assert got["hot", 0] == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10] and got["hot", 9] == list(range(91, 101))
    assert got["cold", 0] == [None, -2, 3] and got["bare", 0] == [] and len(got) == 12


def test_only_groups_cut_by_a_bound_carry_over_and_rows_move_once(spark):
    rows = spark.range(400).selectExpr("case when id < 250 then null else id div 3 end as g", "id % 97 as a", "id as b")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = within(rows, ["g"], ["a", "b"], number="n", slices=16)
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r["b"]: r["n"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    groups = {}
    for i in range(400):
        groups.setdefault(None if i < 250 else i // 3, []).append((i % 97, i))
    assert got == {b: n for members in groups.values() for n, (_, b) in enumerate(sorted(members), 1)}
