import random

import pytest
from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Columns that clash with names the operators use.
    T.StructField("size", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("text_key", T.StringType()),
    T.StructField("bucket", T.StringType()), T.StructField("words", T.StringType()), T.StructField("row", T.StringType()),
])


def documents(spark, rows):
    """rows of (doc_id, text[, source]) with every other column null or clashing."""
    return spark.createDataFrame(
        [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, "x", "y", None, "z", "w", "r") for r in rows], DOCS)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows(seed=3):
    """Nulls, empties, one very long text, ties, repeated rows, copies, near copies, lines and white space."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    long = "\n".join(prose(rng, 30) for _ in range(600))
    lines = [prose(rng, 8) for _ in range(12)]
    rows = [
        (1, None, None), (2, None, "a"), (3, "", "a"), (4, " \t\n ", "b"), (5, base, "b"), (6, base, "b"),
        (7, base.replace(" ", "  "), "c"), (8, near, "c"), (9, long, None), (10, long[5000:9000], "a"),
        (11, "a" * 1500, "a"), (12, "ab" * 700, "a"), (13, "\n".join(lines), "b"),
        (14, "\n".join([*lines[3:9], "own line"]), "b"), (15, "\n".join(["x"] * 9), "b"), (16, "\n" * 5, "b"),
        (17, "Étude ÉCOLE école", "é"), (18, "one two", "b"), (19, base.upper(), "b"), (20, base, "b"), (20, base, "b"),
        (None, "null id " + prose(rng, 60), "b"), (None, "null id " + prose(rng, 60), "b"), (21, "!!! ??? ...", "b"),
        (22, "é" * 300 + base + "é" * 300, "b"), (23, base + base, "b"),
    ]
    rows += [(100 + i, prose(rng, rng.randrange(1, 90)), f"s{i % 3}") for i in range(60)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, odd_rows()).cache()


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])
