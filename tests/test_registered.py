"""Every registered query against its SQL twin."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from marquee.verify.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


# Paged lists need titles whose lists begin on a later page; the smallest tables have none.
LARGER = "/root/testdata/sf0.01"
PAGED = ["film_card_paged", "film_search_paged"]


def connected(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def duck():
    con = connected(FOLDER)
    yield con
    con.close()


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


def test_names():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10


# The corpus operators have tests of their own.
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    compare(spark, duck, name, FOLDER)


@pytest.mark.parametrize("name", PAGED)
def test_paged_query_on_larger_tables(spark, name):
    con = connected(LARGER)
    compare(spark, con, name, LARGER)
    con.close()


def compare(spark, duck, name, folder):
    df = entry_point.queries()[name](spark, folder)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    result = duck.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    want = sorted((tuple(plain(dict(zip(columns, r))[c]) for c in names) for r in result.fetchall()), key=str)
    assert got == want
