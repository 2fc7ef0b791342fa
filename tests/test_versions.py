from datetime import datetime

import pytest
from test_snapshots import random_versions, version

from marquee.operators import backups as B
from marquee.sinks import versions


def day(d):
    return datetime(2025, 10, d, 4, 7, 19)


@pytest.mark.parametrize("seed", [1, 2])
def test_every_version_comes_back(spark, tmp_path, as_rows, seed):
    root = str(tmp_path / "snapshots")
    dicts = random_versions(seed, 7)
    # The first is a full whatever is asked for.
    kinds = ["incr", "incr", "diff", "incr", "full", "incr", "diff"]
    labels = []
    for d, (rows, kind) in enumerate(zip(dicts, kinds), start=1):
        labels.append(versions.take(spark, root, "t", version(spark, rows), ["k"], kind, day(d)))
    assert labels[0] == "20251001-040719F" and labels[2] == "20251001-040719F_20251003-040719D"
    assert labels[5].startswith("20251005-040719F_")
    for d, rows in enumerate(dicts, start=1):
        want = as_rows(version(spark, rows))
        assert as_rows(versions.restore(spark, root, "t", ["k"], target=day(d))) == want
        assert as_rows(versions.restore(spark, root, "t", ["k"], label=labels[d - 1])) == want
    assert as_rows(versions.restore(spark, root, "t", ["k"])) == as_rows(version(spark, dicts[-1]))
    counts = B.type_counts(versions.catalogue(spark, root)).first()
    assert (counts["completos"], counts["incrementales"], counts["diferenciales"]) == (2, 3, 2)


def test_unchanged_table_is_skipped(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    table = version(spark, {1: "a", 2: None})
    assert versions.take(spark, root, "t", table, ["k"], "full", day(1))
    assert versions.take(spark, root, "t", table, ["k"], "incr", day(2)) is None
    assert versions.take(spark, root, "t", table, ["k"], "incr", day(2)) is None
    assert versions.catalogue(spark, root).count() == 1
    with pytest.raises(ValueError):
        versions.restore(spark, root, "other", ["k"])
    with pytest.raises(ValueError):
        versions.restore(spark, root, "t", ["k"], target=datetime(2025, 9, 1))
