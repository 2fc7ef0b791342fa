import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marquee.functions import columns as X
from marquee.functions import text as TX


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,want", [("1994", 1994), ("19x4", None), ("1994\n", None), (" 1994 ", None), ("", None),
                                       (None, None), ("12345", None), ("\\N", None)])
def test_year(spark, text, want):
    assert one(spark, text, X.year_or_null) == want


def test_digits(spark):
    assert one(spark, "12", lambda c: X.digits_or_null(c, "smallint")) == 12
    assert one(spark, "x1", lambda c: X.digits_or_null(c, "smallint")) is None
    with pytest.raises(PySparkException):
        one(spark, "99999", lambda c: X.digits_or_null(c, "smallint"))


@pytest.mark.parametrize("text,want", [("  ", None), (" a b ", "a b"), ("\t", "\t"), (None, None)])
def test_blank(spark, text, want):
    assert one(spark, text, X.blank_to_null) == want


@pytest.mark.parametrize("text,want", [("", None), ("A", ["A"]), ("A,B", ["A", "B"]), ("A,A", ["A", "A"]), (None, None)])
def test_split(spark, text, want):
    assert one(spark, text, X.split_list) == want
    assert one(spark, text, X.list_or_empty) == (want or [])


def test_character_lists(spark):
    assert one(spark, '["A, B"]', X.json_list) == ["A, B"]
    assert one(spark, '["A, B"]', X.stripped_list) == ["A", " B"]
    assert one(spark, "not json", X.json_list) == []
    assert one(spark, None, X.stripped_list) == []


def test_decimal_rounding(spark):
    assert str(one(spark, "8.25", lambda c: c.cast("decimal(3,1)"))) == "8.3"
    with pytest.raises(PySparkException):
        one(spark, "123.4", lambda c: c.cast("decimal(3,1)"))


@pytest.mark.parametrize("raw,want", [(r"a\tb", "a\tb"), (r"a\\tb", r"a\tb"), (r"\\", "\\"), (r"a\qb", "aqb"), ("plain", "plain"),
                                      (r"x\nq\\\ty", "x\nq\\\ty"), (r"\x41b\101c\7", "AbAc\x07"), ("a\\\tb", "a\tb"),
                                      (r"\x", "x"), (r"\\x41", r"\x41"), ("end\\", "end")])
def test_escapes(spark, raw, want):
    assert one(spark, raw, X.decode_escapes) == want


def test_stamps(spark):
    key = "backup:2025-10-09_04-07-19"
    assert one(spark, key, X.key_label) == "20251009-040719"
    assert one(spark, key, lambda c: X.stamp_date(X.key_stamp(c))) == "2025-10-09"
    assert one(spark, key, lambda c: X.stamp_time(X.key_stamp(c))) == "04:07:19"
    assert one(spark, key, lambda c: X.readable_stamp(X.key_stamp(c))) == "2025-10-09 04:07:19"
    assert one(spark, "backup:completo:2025-10-04_22-56-26", X.key_type) == "completo"
    assert one(spark, key, X.key_type) is None
    assert one(spark, "/var/lib/backup/main/20251009-040719F", lambda c: X.tail(c, 17)) == "...0251009-040719F"[:3] + "/var/lib/backup/main/20251009-040719F"[-17:]


@pytest.mark.parametrize("n,want", [(512, "512 bytes"), (10 * 1024, "10 kB"), (24 * 1024**2, "24 MB"), (25 * 1024**3, "25 GB")])
def test_sizes(spark, n, want):
    assert one(spark, n, X.readable_size, "bigint") == want


def test_size_text(spark):
    assert one(spark, "24.1GB", X.size_to_bytes) == round(24.1 * 1024**3)
    assert one(spark, "512B", X.size_to_bytes) == 512
    assert one(spark, "none", X.size_to_bytes) is None


def test_normalise(spark):
    assert one(spark, "Amélie — «Où?»", TX.normalise) == " amelie ou "
    assert TX.normalise_term("Amélie — «Où?»") == "amelie ou"


def brute_trigrams(text):
    out = set()
    for w in TX.normalise_term(text).split():
        p = f"  {w} "
        out |= {p[i:i + 3] for i in range(len(p) - 2)}
    return out


@pytest.mark.parametrize("a,b", [("The Dark Knight", "dark nite"), ("a", "a"), ("abc", "xyz"), ("", "x")])
def test_trigram_similarity(spark, a, b):
    x, y = brute_trigrams(a), brute_trigrams(b)
    want = len(x & y) / len(x | y) if x | y else 0.0
    assert one(spark, a, lambda c: TX.trigram_similarity(c, b)) == pytest.approx(want)
    assert set(one(spark, a, TX.trigrams)) == x
