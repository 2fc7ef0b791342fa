import random
import shutil

import pytest
from test_snapshots import version

from marquee.operators import digests
from marquee.operators import snapshots as SN


def versions(seed):
    rnd = random.Random(seed)
    old = {k: rnd.choice(["a", "b", None]) for k in range(0, 3000, 2)}
    new = dict(old)
    for k in range(900, 930):
        new[k] = "changed"
    for k in (1000, 1002, 5000):
        new.pop(k, None) if k in new else new.update({k: None})
    return old, new


@pytest.mark.parametrize("seed", [1, 2])
def test_diff_reads_differing_ranges(spark, tmp_path, as_rows, seed):
    old, new = versions(seed)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    digests.write_version(version(spark, old), ["k"], a)
    digests.write_version(version(spark, new), ["k"], b, follows=a)
    assert as_rows(digests.diff_versions(spark, a, b, ["k"])) == as_rows(SN.diff(version(spark, old), version(spark, new), ["k"]))
    leaves = digests.changed_leaves(spark, a, b)
    assert 0 < len(leaves) < 80 and digests.version(spark, a, leaves).count() < 200
    assert not digests.unchanged(spark, a, b)
    assert as_rows(digests.version(spark, b)) == as_rows(version(spark, new))


def test_an_unchanged_version_ends_without_its_rows(spark, tmp_path):
    old, _ = versions(3)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    digests.write_version(version(spark, old), ["k"], a)
    # The same rows, dealt and ordered otherwise.
    digests.write_version(version(spark, old).repartition(7, "v"), ["k"], b, follows=a)
    for path in (a, b):
        shutil.rmtree(f"{path}/rows")
    assert digests.unchanged(spark, a, b) and digests.changed_leaves(spark, a, b) == []


def test_nulls_empty_tables_and_other_ranges(spark, tmp_path, as_rows):
    a, b, c, d = (str(tmp_path / n) for n in "abcd")
    frame = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "k int, v string, w string")
    swapped = spark.createDataFrame([(1, "x", None), (2, None, "x")], "k int, v string, w string")
    digests.write_version(frame, ["k"], a)
    digests.write_version(swapped, ["k"], b, follows=a)
    assert {r["op"] for r in digests.diff_versions(spark, a, b, ["k"]).collect()} == {"update"}
    digests.write_version(frame.limit(0), ["k"], c, follows=a)
    assert as_rows(digests.diff_versions(spark, a, c, ["k"]), "op", "k") == [("delete", 1), ("delete", 2)]
    assert as_rows(digests.diff_versions(spark, c, a, ["k"]), "op", "k") == [("insert", 1), ("insert", 2)]
    digests.write_version(frame.unionByName(spark.createDataFrame([(i, "y", "z") for i in range(3, 60)], frame.schema)), ["k"], d)
    with pytest.raises(ValueError):
        digests.changed_leaves(spark, a, d)
