import random

import pytest

from marquee.sources.tsv import list_paths
from marquee.streaming import ingest, levels

SCHEMA = "k int, a string, b int, n int"


def batches_of(seed, count):
    rnd = random.Random(seed)
    return [[(rnd.randrange(15), rnd.choice([None, f"a{i}-{j}"]), rnd.choice([None, i * 100 + j]), j) for j in range(8)]
            for i in range(count)]


def brute(batches, base=()):
    table = {}
    for rows in ([list(base)] if base else []) + batches:
        for k, a, b, n in sorted(rows, key=lambda r: r[3]):
            old = table.get(k, (None, None, None))
            table[k] = tuple(new if new is not None else was for new, was in zip((a, b, n), old))
    return sorted(((k, *v) for k, v in table.items()), key=str)


@pytest.mark.parametrize("fan_out", [2, 3])
def test_folded_levels_equal_all_batches(spark, tmp_path, as_rows, fan_out):
    target = str(tmp_path / "target")
    batches = batches_of(fan_out, 9)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in batches]
    schema = frames[0].schema
    for i, frame in enumerate(frames):
        ingest.put_batch(frame, i, target, ["k"], ["n"], fan_out)
    assert as_rows(ingest.fold(spark, target, schema, ["k"])) == brute(batches)
    runs = levels.live_runs(spark, target)
    assert [(r.lo, r.hi) for r in runs] == ([(0, 7), (8, 8)] if fan_out == 2 else [(0, 8)])
    base = [(99, "base", 1, 0), (3, "base", 2, 0)]
    with_base = ingest.fold(spark, target, schema, ["k"], spark.createDataFrame(base, SCHEMA))
    assert as_rows(with_base) == brute(batches, base)


def test_a_replay_after_a_merge_changes_nothing(spark, tmp_path, as_rows):
    target = str(tmp_path / "target")
    batches = batches_of(7, 5)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in batches]
    for i in (0, 1, 2, 3, 4, 1, 3, 4):  # 1 and 3 lie in a run when they come again, 4 does not
        ingest.put_batch(frames[i], i, target, ["k"], ["n"], 2)
    schema = frames[0].schema
    assert as_rows(ingest.fold(spark, target, schema, ["k"])) == brute(batches)
    assert levels.forget(spark, target) > 0
    assert as_rows(ingest.fold(spark, target, schema, ["k"])) == brute(batches)
    assert len(list_paths(spark, f"{target}/batch=*")) == 1 and levels.forget(spark, target) == 0


def test_an_unfinished_batch_or_run_does_not_count(spark, tmp_path, as_rows):
    target = tmp_path / "target"
    frame = spark.createDataFrame([(1, "x", 1, 1)], SCHEMA)
    ingest.put_batch(frame, 0, str(target), ["k"], ["n"], 2)
    for left in ("batch=1", "_levels/run-0-1-left", "_levels/manifest/v=0"):
        spark.createDataFrame([(1, "half", 2, 2)], SCHEMA).write.parquet(str(target / left))
        (target / left / "_SUCCESS").unlink()
    assert as_rows(ingest.fold(spark, str(target), frame.schema, ["k"])) == [(1, "x", 1, 1)]
    ingest.put_batch(spark.createDataFrame([(2, "y", 3, 1)], SCHEMA), 1, str(target), ["k"], ["n"], 2)
    assert [(r.lo, r.hi, r.level) for r in levels.live_runs(spark, str(target))] == [(0, 1, 1)]


def test_no_batches(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert ingest.fold(spark, str(tmp_path / "none"), schema, ["k"]).count() == 0
    assert levels.compact(spark, str(tmp_path / "none"), schema, ["k"]) == []
