import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import snapshots as SN


def version(spark, rows):
    return spark.createDataFrame(sorted(rows.items()), "k int, v string") if rows else spark.createDataFrame([], "k int, v string")


def random_versions(seed, n=4):
    rnd = random.Random(seed)
    out = [{k: rnd.choice(["a", "b", None]) for k in range(30)}]
    for _ in range(n - 1):
        nxt = {k: v for k, v in out[-1].items() if rnd.random() > 0.2}
        for k in range(40):
            if rnd.random() < 0.2:
                nxt[k] = rnd.choice(["a", "b", "c", None])
        out.append(nxt)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_round_trip(spark, as_rows, seed):
    dicts = random_versions(seed)
    frames = [version(spark, d) for d in dicts]
    sets = []
    for i in range(1, len(frames)):
        changes = SN.diff(frames[i - 1], frames[i], ["k"])
        sets.append((i, changes))
        old, new = dicts[i - 1], dicts[i]
        want = [("insert", k, v) for k, v in new.items() if k not in old]
        want += [("update", k, v) for k, v in new.items() if k in old and old[k] != v]
        want += [("delete", k, None) for k in old if k not in new]
        assert as_rows(changes) == sorted(want, key=str)
        assert as_rows(SN.apply_changes(frames[i - 1], changes, ["k"])) == as_rows(frames[i])
    assert as_rows(SN.rebuild(frames[0], sets, ["k"])) == as_rows(frames[-1])
    assert as_rows(SN.rebuild(frames[0], sets[:2], ["k"])) == as_rows(frames[2])


def test_no_changes(spark):
    one = version(spark, {1: "a", 2: None})
    assert not SN.has_changes(SN.diff(one, one, ["k"]))
    assert SN.has_changes(SN.diff(one, version(spark, {1: "b", 2: None}), ["k"]))


def catalogue(spark):
    rows = [("main", "full", 1), ("main", "incr", 2), ("main", "diff", 3), ("main", "incr", 4), ("main", "full", 5),
            ("main", "incr", 6), ("main", "diff", 7), ("main", "diff", 8), ("main", "incr", 9), ("side", "incr", 2), ("side", "full", 3)]
    df = spark.createDataFrame(rows, "stanza string, type string, d int")
    return df.withColumn("ts", F.timestamp_seconds(F.col("d") * 86400)).withColumn("label", F.concat("stanza", F.col("d").cast("string")))


def chain(df):
    return sorted((r["stanza"], r["d"], r["role"]) for r in df.collect())


def test_restore_chain(spark):
    df = catalogue(spark)
    assert chain(SN.restore_chain(df)) == [("main", 5, "full"), ("main", 8, "diff"), ("main", 9, "incr"), ("side", 3, "full")]
    at = F.timestamp_seconds(F.lit(4 * 86400))
    assert chain(SN.restore_chain(df, at)) == [("main", 1, "full"), ("main", 3, "diff"), ("main", 4, "incr"), ("side", 3, "full")]
    assert chain(SN.restore_set(df, "main6")) == [("main", 5, "full"), ("main", 6, "incr")]


def test_as_of_log(spark, as_rows):
    log = spark.createDataFrame([(1, "upsert", "x", 1), (2, "upsert", "x", 2), (3, "delete", "x", None), (2, "upsert", "y", 7)],
                                "s int, op string, k string, v int")
    assert as_rows(SN.rebuild_log(log, ["k"], "s", F.lit(2))) == [("x", 2), ("y", 7)]
    assert as_rows(SN.rebuild_log(log, ["k"], "s")) == [("y", 7)]


def test_two_fulls_at_one_time(spark):
    rows = [("s", "a", "full", 1), ("s", "b", "full", 1), ("s", "c", "diff", 2), ("s", "d", "diff", 2), ("s", "e", "incr", 3)]
    entries = spark.createDataFrame(rows, "stanza string, label string, type string, d int").selectExpr("*", "timestamp_seconds(d) as ts")
    assert sorted((r["label"], r["role"]) for r in SN.restore_chain(entries).collect()) == [("b", "full"), ("d", "diff"), ("e", "incr")]
