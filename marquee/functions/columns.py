"""Scalar and array expressions. Everything here stays a JVM column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "\\N"


def blank_to_null(c: Column) -> Column:
    """Trim spaces; nothing left means NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def mark_to_null(c: Column) -> Column:
    """The text marker for a missing value becomes NULL."""
    return F.nullif(c, F.lit(NULL_MARK))


def present(c: Column) -> Column:
    """True for values that are neither NULL nor the missing-value marker."""
    return c.isNotNull() & (c != NULL_MARK)


def has_key(c: Column) -> Column:
    """Rows with a NULL or empty key never qualify."""
    return c > ""


def year_or_null(c: Column) -> Column:
    """Exactly four digits, else NULL."""
    return F.when(c.rlike(r"^[0-9]{4}\z"), c.cast("smallint"))


def digits_or_null(c: Column, kind: str = "int") -> Column:
    """Digits only, else NULL; a number too large for ``kind`` raises."""
    return F.when(c.rlike(r"^[0-9]+\z"), c.cast(kind))


def flag(c: Column) -> Column:
    return c == "1"


def split_list(c: Column) -> Column:
    """Comma list to array; the empty text is an empty list, so it explodes to nothing."""
    return F.split(F.nullif(c, F.lit("")), ",")


def list_or_empty(c: Column) -> Column:
    return F.coalesce(split_list(c), F.array().cast("array<string>"))


def json_list(c: Column) -> Column:
    """JSON text to array; missing or broken text gives an empty array."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def stripped_list(c: Column) -> Column:
    """Array by stripping brackets and quotes; a comma inside a value splits it."""
    bare = F.replace(F.btrim(c, F.lit("[]")), F.lit('"'), F.lit(""))
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.split(bare, ","))


def float_or_null(c: Column) -> Column:
    return c.cast("double")


def nth(c: Column, i: int) -> Column:
    """Element by zero-based position, NULL when out of range."""
    return F.get(c, F.lit(i))


def index_of(c: Column, value) -> Column:
    """Zero-based position of the first match, -1 when absent."""
    return F.array_position(c, value).cast("int") - 1


# What a letter behind a backslash stands for.
ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}


def decode_escapes(c: Column) -> Column:
    """Backslash escapes of a text dump: letters, octal and hexadecimal codes; any other character
    stands for itself. Doubled backslashes are taken apart first, so that an escaped backslash
    before a letter is not read as an escape."""

    def coded(seg: Column, pattern: str, base: int) -> tuple[Column, Column]:
        digits = F.regexp_extract(seg, pattern, 1)
        text = F.concat(F.char(F.conv(digits, base, 10).cast("bigint")), F.regexp_replace(seg, pattern, ""))
        return digits != "", text

    def segment(seg: Column) -> Column:
        letter, rest = F.substring(seg, 2, 1), F.regexp_replace(seg, r"(?s)^\\.?", "")
        plain = letter
        for mark, char in ESCAPES.items():
            plain = F.when(letter == mark, char).otherwise(plain)
        is_hex, hex_text = coded(seg, r"^\\x([0-9A-Fa-f]{1,2})", 16)
        is_octal, octal_text = coded(seg, r"^\\([0-7]{1,3})", 8)
        return (
            F.when(~seg.startswith("\\"), seg)
            .when(is_hex, hex_text).when(is_octal, octal_text).otherwise(F.concat(plain, rest))
        )

    def piece(p: Column) -> Column:
        return F.array_join(F.transform(F.split(p, r"(?=\\)"), segment), "")

    parts = F.split(c, r"\\\\")
    return F.when(c.isNull() | ~F.contains(c, F.lit("\\")), c).otherwise(F.array_join(F.transform(parts, piece), "\\"))


# --- snapshot stamps -------------------------------------------------------------------------

STAMP_FORMAT = "yyyy-MM-dd_HH-mm-ss"
LABEL_FORMAT = "yyyyMMdd-HHmmss"

# Snapshot type, registered name, and the letter its repository label ends in.
TYPE_LABELS = {"full": "completo", "incr": "incremental", "diff": "diferencial"}
TYPE_LETTERS = {"full": "F", "incr": "I", "diff": "D"}


def stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP_FORMAT)


def stamp_date(s: Column) -> Column:
    return F.substring_index(s, "_", 1)


def stamp_time(s: Column) -> Column:
    return F.translate(F.substring_index(s, "_", -1), "-", ":")


def stamp_to_timestamp(s: Column) -> Column:
    return F.to_timestamp(s, STAMP_FORMAT)


def readable_stamp(s: Column) -> Column:
    return F.date_format(stamp_to_timestamp(s), "yyyy-MM-dd HH:mm:ss")


def key_stamp(key: Column) -> Column:
    """Stamp part of ``backup:<stamp>`` and of the older ``backup:<type>:<stamp>``."""
    return F.substring_index(key, ":", -1)


def key_type(key: Column) -> Column:
    """Type part of ``backup:<type>:<stamp>``; NULL for the newer key."""
    parts = F.split(key, ":")
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(1)))


def key_label(key: Column) -> Column:
    """Repository form ``YYYYMMDD-HHMMSS`` of a catalogue key."""
    return F.replace(F.replace(key_stamp(key), F.lit("-"), F.lit("")), F.lit("_"), F.lit("-"))


def code_label(code: Column) -> Column:
    out = None
    for short, long in TYPE_LABELS.items():
        out = F.when(code == short, long) if out is None else out.when(code == short, long)
    return out


def tail(c: Column, n: int) -> Column:
    """Ellipsis and the last ``n`` characters."""
    return F.concat(F.lit("..."), F.right(c, F.lit(n)))


# Size units, smallest first.
SIZE_UNITS = ["bytes", "kB", "MB", "GB", "TB", "PB"]


def readable_size(n: Column) -> Column:
    """Bytes as text: a value moves to the next unit once it reaches 10 of it, rounded half up."""
    out = F.when(n < 10 * 1024, F.concat(n.cast("string"), F.lit(" bytes")))
    for i, unit in enumerate(SIZE_UNITS[1:], start=1):
        scaled = F.round(n / F.lit(float(1024**i))).cast("bigint")
        text = F.concat(scaled.cast("string"), F.lit(f" {unit}"))
        last = i == len(SIZE_UNITS) - 1
        out = out.otherwise(text) if last else out.when(n < 10 * 1024 ** (i + 1), text)
    return out


def size_to_bytes(text: Column) -> Column:
    """``24.1GB``, ``28.5 MB``, ``9 kB``, ``512B`` and ``512 bytes`` to bytes."""
    pattern = r"([0-9]+(?:\.[0-9]+)?)\s*([KkMGTP]?)(?:B|bytes)"
    number, unit = F.regexp_extract(text, pattern, 1), F.upper(F.regexp_extract(text, pattern, 2))
    factor = F.lit(1.0)
    for i, letter in enumerate("KMGTP", start=1):
        factor = F.when(unit == letter, float(1024**i)).otherwise(factor)
    return F.when(number != "", F.round(number.cast("double") * factor).cast("bigint"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
