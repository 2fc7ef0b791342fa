import random

import pytest
from pyspark.sql import functions as F

from marquee.schemas import staging_names
from marquee.sources import tsv


def write(tmp_path, name, lines, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes("\n".join(lines).encode(encoding) + b"\n")
    return str(path)


HEADER = "titleId\tordering\ttitle\tregion\tlanguage\ttypes\tattributes\tisOriginalTitle"


def test_reader(spark, tmp_path):
    path = write(tmp_path, "a.tsv", [
        HEADER,
        'tt1\t1\t"Unbalanced\tNA\t\\N\t\t\\N\t0',
        "tt2\t2\tCafé None\tFR\tfr\t\\N\t\\N\t1",
        "tt3\t3\tback\\\\slash\\ttab\tUS\t\\N\t\\N\t\\N\t0",
        "short\trow",
    ])
    good, bad = tsv.read_tsv(spark, path, staging_names("title_akas"))
    got = {r["titleid"]: r for r in good.collect()}
    assert set(got) == {"tt1", "tt2", "tt3"}
    assert got["tt1"]["title"] == '"Unbalanced' and got["tt1"]["region"] == "NA"
    assert got["tt1"]["types"] == "" and got["tt1"]["language"] is None
    assert got["tt2"]["title"] == "Café None"
    assert got["tt3"]["title"] == "back\\slash\ttab"
    assert [tuple(r) for r in bad.collect()] == [("short\trow", 2)]


def test_options(spark, tmp_path):
    path = write(tmp_path, "b.tsv", [HEADER, "tt1\t1\tCafé\tNA\t\\N\t\\N\t\\N\t0"], "latin-1")
    good, _ = tsv.read_tsv(spark, path, staging_names("title_akas"), encoding="ISO-8859-1", extra_na=["NA"])
    row = good.first()
    assert row["title"] == "Café" and row["region"] is None


def test_missing_and_strict(spark, tmp_path):
    empty = tsv.read_staging(spark, str(tmp_path / "none.tsv"), "title_ratings")
    assert empty.columns == ["tconst", "averagerating", "numvotes"] and empty.count() == 0
    short = write(tmp_path, "c.tsv", ["tconst\taverageRating\tnumVotes", "tt1\t5.0"])
    with pytest.raises(tsv.BadRowsError, match="width"):
        tsv.read_staging(spark, short, "title_ratings", strict=True)
    long = write(tmp_path, "d.tsv", ["tconst\taverageRating\tnumVotes", "tt123456789012\t5.0\t1"])
    with pytest.raises(tsv.BadRowsError, match="over-long"):
        tsv.read_staging(spark, long, "title_ratings", strict=True)
    assert tsv.read_staging(spark, long, "title_ratings").count() == 1


def test_all_files_and_append(spark, tmp_path):
    write(tmp_path, "title.ratings.tsv", ["tconst\taverageRating\tnumVotes", "tt1\t5.0\t7"])
    tables = tsv.read_all_staging(spark, str(tmp_path))
    assert len(tables) == 7 and tables["title_ratings"].count() == 1 and tables["title_basics"].count() == 0
    kept = str(tmp_path / "kept")
    tsv.write_staging(tables["title_ratings"], kept)
    tsv.write_staging(tables["title_ratings"], kept)
    assert spark.read.parquet(kept).count() == 1
    tsv.write_staging(tables["title_ratings"], kept, append=True)
    assert spark.read.parquet(kept).count() == 2


def test_first_line_goes_by_position(spark, tmp_path):
    for n in (1, 2):
        write(tmp_path, f"h{n}.tsv", ["titleId averageRating numVotes", "tconst\taverageRating\tnumVotes", f"tt{n}\t5.0\t1", ""])
    good, bad = tsv.read_tsv(spark, str(tmp_path / "h*.tsv"), staging_names("title_ratings"))
    assert sorted(r["tconst"] for r in good.collect()) == ["tconst", "tconst", "tt1", "tt2"] and bad.count() == 0


def test_any_number_of_backslashes(spark):
    lines = spark.createDataFrame([("a" + "\\" * n + "\tb", n) for n in (0, 1, 2, 197, 198, 203, 4001, 4002)], "value string, n int")
    widths = {r["n"]: r["_width"] for r in tsv.cut(lines.select("value", "n"), ["x", "y"], escapes=True).select(
        "_width", F.length("value").alias("l")).selectExpr("l - 3 as n", "_width").collect()}
    assert widths == {n: 1 if n % 2 else 2 for n in (0, 1, 2, 197, 198, 203, 4001, 4002)}


def test_escaped_tabs(spark, tmp_path):
    path = write(tmp_path, "e.tsv", ["a\\\tb\t1", "c\\\\\t2", "d\\\\\\\te\t3"])
    good, bad = tsv.read_tsv(spark, path, ["x", "y"], header=False)
    assert sorted(tuple(r) for r in good.collect()) == [("a\tb", "1"), ("c\\", "2"), ("d\\\te", "3")]
    assert bad.count() == 0


def sequential(text):
    """Records of a text read from front to back: a line feed behind an odd number of backslashes does not end one."""
    out, record = [], None
    for line in text.split("\n")[1:]:
        record = line if record is None else record + "\n" + line
        if (len(line) - len(line.rstrip("\\"))) % 2 == 0:
            out.append(record)
            record = None
    return sorted(r for r in out + ([record] if record is not None else []) if r)


@pytest.mark.parametrize("split", [16, 60, 200, 10_000])
def test_records_go_on_behind_a_backslash(spark, tmp_path, split):
    rng = random.Random(split)
    for k in range(2):
        ends = ["", "", "\\", "\\\\", "\\\\\\"]
        body = [f"{k}-{i}" + "x" * rng.randrange(30) + rng.choice(ends) for i in range(80)]
        body[30:30] = ["\\", "", "\\", "\\", "", "y\\"]  # bare backslashes and blank lines
        (tmp_path / f"{k}.tsv").write_text("heading\n" + "\n".join(body) + "\n")
    want = sorted(r for k in range(2) for r in sequential((tmp_path / f"{k}.tsv").read_text()[:-1]))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert sorted(r["value"] for r in tsv.continued_lines(spark, str(tmp_path / "*.tsv")).collect()) == want
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_continued_fields(spark, tmp_path):
    path = write(tmp_path, "c.tsv", ["a\tb", "1\tone\\", "two\tis\\\\", "2\tplain", "3\\", "3\t\\N", "4\tlast\\"])
    good, bad = tsv.read_tsv(spark, path, ["a", "b"], continued=True)
    assert {r["a"]: r["b"] for r in good.collect() if r["a"] != "4"} == {"2": "plain", "3\n3": None}
    assert [r["value"] for r in bad.collect()] == ["1\tone\\\ntwo\tis\\\\"]


def test_continued_lines_stay_where_they_are_read(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_bytes(b"heading\n" + b"".join(b"%d\tcaf\xe9\\\nmore\n" % i for i in range(50)))
    found = tsv.continued_lines(spark, str(path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(file") == plan.count("Exchange ") <= 2 and "SortMergeJoin" not in plan
    want = sorted(b"%d\tcaf\xe9\\\nmore" % i for i in range(50))
    assert sorted(bytes(r["b"]) for r in found.select(F.col("value").cast("binary").alias("b")).collect()) == want
