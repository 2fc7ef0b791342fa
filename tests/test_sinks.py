import catalogue_days as days
import duckdb
import pyarrow.parquet as pq
import pytest

from marquee.operators import integrity, normalize
from marquee.plans import directors
from marquee.sinks import layout, publish
from marquee.streaming import ingest


def test_publish_and_rollback(spark, tmp_path, as_rows):
    root = str(tmp_path / "star")
    staging = days.staging(spark)
    rows = publish.publish(spark, root, lambda store: normalize.build_star(staging, store=store), integrity.check_star, layout.write_star)
    assert rows["titles"] == 12 and rows["title_principals"] == 14
    now = publish.current(spark, root)
    assert as_rows(directors.director_info(now, "Christopher Nolan")) == [("nm0000001", "Christopher Nolan", 1970, None, 2)]
    broken = dict(now, ratings=now["ratings"].unionByName(spark.sql("select 'ttX' tconst, cast(1 as decimal(3,1)) average_rating, 1L num_votes")))
    with pytest.raises(publish.RejectedRun):
        publish.publish(spark, root, broken, integrity.check_star)
    assert publish.current(spark, root)["ratings"].count() == 9
    # Publishing a run built from the current one never overwrites what it reads.
    publish.publish(spark, root, {k: v for k, v in now.items() if k != "akas"})
    assert publish.history(spark, root).select("seq").distinct().count() == 2
    assert "akas" not in publish.current(spark, root) and "akas" in publish.current(spark, root, 1)


def test_layouts(spark, tmp_path):
    star = days.star(spark)
    by_type = str(tmp_path / "by_type")
    layout.write_partitioned(star["titles"], by_type, ["title_type"], ["tconst"], partitions=3)
    plan = spark.read.parquet(by_type).filter("title_type = 'movie'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(title_type" in plan
    layout.write_sorted(star["people"], str(tmp_path / "people"), ["primary_name"], partitions=2)
    assert spark.read.parquet(str(tmp_path / "people")).count() == 18
    profile = layout.profile(spark, {"titles": by_type, "people": str(tmp_path / "people")}).collect()
    assert {r["table"]: r["rows"] for r in profile} == {"titles": 12, "people": 18}
    on_disk = {n: sum(f.stat().st_size for f in (tmp_path / n).rglob("*.parquet")) for n in ("by_type", "people")}
    assert {r["table"]: r["bytes"] for r in profile} == {"titles": on_disk["by_type"], "people": on_disk["people"]}
    assert [r["bytes"] for r in profile] == sorted(on_disk.values(), reverse=True) and all(r["size"] for r in profile)


def file_bounds(path, column):
    """(low, high) of a column in every file, from the footers."""
    out = []
    for f in path.rglob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return out


def share_read(path, column, low, high):
    bounds = file_bounds(path, column)
    return sum(a <= high and b >= low for a, b in bounds) / len(bounds)


def test_curve_serves_every_key(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_orderkey", "l_partkey", "l_extendedprice")
    keys = ["l_partkey", "l_extendedprice", "l_orderkey"]
    layout.write_curve(rows, str(tmp_path / "curve"), keys, cells=64, partitions=64)
    layout.write_sorted(rows, str(tmp_path / "sorted"), keys, partitions=64)
    back = spark.read.parquet(str(tmp_path / "curve"))
    assert back.columns == rows.columns and back.exceptAll(rows).count() == 0 == rows.exceptAll(back).count()
    for key in keys:
        low, high = rows.approxQuantile(key, [0.60, 0.62], 0.001)
        assert share_read(tmp_path / "curve", key, low, high) <= 0.5
        assert key == keys[0] or share_read(tmp_path / "sorted", key, low, high) > 0.9
    # Ranges of two keys at once read about the product of their shares.
    (a, b), (c, d) = rows.approxQuantile(keys[:2], [0.60, 0.62], 0.001)
    both = [x <= b and y >= a and u <= d and v >= c for (x, y), (u, v) in
            zip(file_bounds(tmp_path / "curve", keys[0]), file_bounds(tmp_path / "curve", keys[1]))]
    assert sum(both) / len(both) <= 0.25


def test_curve_of_odd_keys(spark, tmp_path):
    """NULL, NaN, infinite, constant and heavy values: every row comes back, a heavy cell lies in several files."""
    values = [None, float("nan"), float("inf"), float("-inf"), 0.0, -1.5] + [7.0] * 3000
    rows = spark.createDataFrame([(i, v, 1) for i, v in enumerate(values)], "id long, v double, one int")
    path = tmp_path / "odd"
    layout.write_curve(rows, str(path), ["v", "one"], cells=16, partitions=6)
    assert sorted(r["id"] for r in spark.read.parquet(str(path)).collect()) == list(range(len(values)))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in path.rglob("*.parquet")]
    assert len(sizes) > 3 and max(sizes) < 1500
    layout.write_curve(rows.limit(0), str(tmp_path / "none"), ["v"], cells=4)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        layout.curve_position(rows, ["v"] * 20, cells=16)


def test_column_profile_reads_footers_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 1000, 1, 4).selectExpr(
        "id", "if(id % 10 = 0, null, id / 4) as x", "cast(id as string) as s", "array(id) as nested", "id as `odd name`")
    rows.write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    found = layout.column_profile(spark, {"t": path})
    assert "PushedAggregation: [" in found._jdf.queryExecution().toString()
    got = {r["column"]: tuple(r)[2:] for r in found.collect()}
    assert got == {"id": (1000, 0, 0.0, 999.0), "x": (1000, 100, 0.25, 249.75), "s": (1000, 0, None, None), "odd name": (1000, 0, 0.0, 999.0)}
    scanned = layout.column_profile(spark, {"t": path}, footers=False)
    assert {r["column"]: tuple(r)[2:] for r in scanned.collect()} == got
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    # The sizes of the files agree with what another engine reads from their footers.
    rows_by_footer = duckdb.sql(f"select sum(num_rows) from parquet_file_metadata('{path}/*.parquet')").fetchall()[0][0]
    assert rows_by_footer == 1000


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    star = days.star(spark)
    for name in ("titles", "ratings"):
        layout.write_bucketed(star[name], f"b_{name}", "tconst", 4, str(tmp_path / name))
    layout.refresh_statistics(spark, "b_titles", ["tconst"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_titles").join(spark.table("b_ratings"), "tconst")
        assert joined.count() == 9
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_equals_batch_and_replays(spark, tmp_path, as_rows):
    schema = "i int, k string, a int, b string"
    source = tmp_path / "in"
    chunks = [[(1, "x", 1, None), (2, "y", None, "p")], [(3, "x", None, "q"), (4, "x", 5, None)], [(5, "z", 0, None), (6, None, 1, "lost")]]
    for n, rows in enumerate(chunks):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
    frame = spark.createDataFrame([], schema)
    target, state = str(tmp_path / "changes"), str(tmp_path / "state")

    def run():
        stream = ingest.file_stream(spark, str(source), frame.schema, files_per_batch=1)
        return ingest.ingest(spark, stream, target, state, ["k"], ["i"])

    # Later files win where files arrive in order; here values do not compete across files but for x.
    got = {r["k"]: (r["a"], r["b"]) for r in run().collect()}
    assert got["y"] == (None, "p") and got["z"] == (0, None) and got["x"][1] == "q" and set(got) == {"x", "y", "z"}
    assert {r["k"]: (r["a"], r["b"]) for r in run().collect()} == got
    spark.createDataFrame([(7, "y", 9, None)], schema).coalesce(1).write.mode("append").parquet(str(source))
    assert {r["k"]: (r["a"], r["b"]) for r in run().collect()}["y"] == (9, "p")
    base = spark.createDataFrame([(0, "y", 1, "old"), (0, "w", 2, "kept")], schema)
    folded = {r["k"]: (r["a"], r["b"]) for r in ingest.fold(spark, target, frame.schema, ["k"], base).collect()}
    assert folded["w"] == (2, "kept") and folded["y"] == (9, "p")
