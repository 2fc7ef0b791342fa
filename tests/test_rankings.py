import datetime
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marquee.operators import rankings
from marquee.operators import snapshots as SN
from marquee.verify.registry import QUERIES


def entries(rows):
    return rows.where("d is not null").select(F.explode(F.split("d", ",")).alias("nconst"))


def days(seed, n=6):
    """Six daily versions: titles come, go and change directors."""
    rnd, out = random.Random(seed), [{}]
    for _ in range(n):
        table = {k: v for k, v in out[-1].items() if rnd.random() > 0.15}
        for k in range(40):
            if rnd.random() < 0.3:
                table[k] = rnd.choice([None, ",".join(rnd.sample(["p", "q", "r", "s", "t"], rnd.randrange(1, 4)))])
        out.append(table)
    return out


def test_counts_follow_every_day(spark, as_rows):
    tables = days(1)
    frames = [spark.createDataFrame(sorted(t.items()), "k int, d string") for t in tables]
    counts = rankings.recount(frames[0], entries)
    for old, new in zip(frames, frames[1:]):
        change = rankings.deltas(SN.diff(old, new, ["k"]), old, ["k"], entries)
        counts = spark.createDataFrame(rankings.moved(counts, change).collect(), "nconst string, n long")
        assert as_rows(counts) == as_rows(rankings.recount(new, entries))


def test_top_and_wrong_counts(spark, as_rows):
    counts = spark.createDataFrame([("a", 2), ("b", 5), ("c", 5), ("d", 1)], "nconst string, n long")
    people = spark.createDataFrame([("b", "B"), ("a", "A")], "nconst string, primaryName string")
    assert [tuple(r) for r in rankings.top(counts, people, 3).orderBy(F.desc("cantidad"), "nconst").collect()] == [
        ("b", "B", 5), ("c", None, 5), ("a", "A", 2)]
    gone = spark.createDataFrame([("a", -2), ("d", -3)], "nconst string, n long")
    with pytest.raises(PySparkException):
        rankings.moved(counts, gone).collect()
    assert as_rows(rankings.moved(counts, gone.where("nconst = 'a'"))) == [("b", 5), ("c", 5), ("d", 1)]


def test_both_versions_read_one_exchange_of_the_documents(spark, tmp_path, monkeypatch):
    lines = [(k, k * line % 7, line, "ANR"[(k + line) % 3], "O") for k in range(40) for line in range(1, 4) if k != 5]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, 1, "1-URGENT", datetime.datetime(2000, 1, 1), 1.0) for k in range(38)],
                          "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp, o_totalprice double").write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(k, 1.0, "m") for k in range(7)], "c_custkey long, c_acctbal double, c_mktsegment string").write.parquet(
        str(tmp_path / "customer.parquet"))
    plans, moved = [], rankings.moved

    def seen(*given):
        counts = moved(*given)
        counts.collect()
        plans.append(counts._jdf.queryExecution().executedPlan().toString())
        return counts

    monkeypatch.setattr(rankings, "moved", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [(r["nconst"], r["cantidad"]) for r in QUERIES["maintained_actors"](spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    counts = Counter(f"nm{part:07}" for order, part, _, flag, _ in lines if order < 38 and flag in "AN")
    assert dict(got) == counts and len(got) == len(counts)
    final = plans[0].split("== Initial Plan ==")[0]
    shuffled = [x for x in final.splitlines() if "Exchange hashpartitioning(tconst" in x and "REPARTITION_BY_COL" in x]
    assert len([x for x in shuffled if "ReusedExchange" not in x]) == 1 and len(shuffled) > 1
