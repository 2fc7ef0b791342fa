"""Text normalisation, tokens and trigrams as column expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters and their plain forms, position by position.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyy"


def normalise(c: Column) -> Column:
    """Lower case, plain letters, every run of other characters one space, a space at both ends."""
    plain = F.translate(F.lower(c), ACCENTED, PLAIN)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def normalise_term(text: str) -> str:
    """The same rule for a search term given by the caller."""
    plain = text.lower().translate(str.maketrans(ACCENTED, PLAIN))
    kept = "".join(ch if unicodedata.category(ch)[0] in "LN" else " " for ch in plain)
    return re.sub(" +", " ", kept).strip()


def phrase_match(c: Column, phrase: str) -> Column:
    """The whole phrase, bounded by word ends. A phrase without letters or digits matches nothing."""
    term = normalise_term(phrase)
    return F.contains(normalise(c), F.lit(f" {term} ")) if term else F.lit(False)


def token_score(c: Column, query: str) -> Column:
    """How many distinct words of the query the text holds."""
    words = sorted(set(normalise_term(query).split()))
    text = normalise(c)
    return sum((F.contains(text, F.lit(f" {w} ")).cast("int") for w in words), F.lit(0))


# Overlapping triples that start at a word's padding or inside a word, never behind its end.
TRIPLES = r"(?=(  \S| \S.|\S\S.))"


def trigrams(c: Column) -> Column:
    """Distinct letter triples of every word, each word padded by two spaces before and one after.

    One look-ahead pass over the padded text; no function is called per letter.
    """
    padded = F.replace(normalise(c), F.lit(" "), F.lit("  "))
    return F.array_distinct(F.regexp_extract_all(padded, F.lit(TRIPLES), F.lit(1)))


def term_trigrams(text: str) -> list[str]:
    """Trigrams of a caller's search term."""
    out = set()
    for w in normalise_term(text).split():
        padded = f"  {w} "
        out.update(padded[i:i + 3] for i in range(len(padded) - 2))
    return sorted(out)


def trigram_similarity(c: Column, term: str) -> Column:
    """Shared trigrams over all trigrams of both texts."""
    grams = term_trigrams(term)
    mine = trigrams(c)
    shared = F.size(F.array_intersect(mine, F.array(*[F.lit(g) for g in grams]).cast("array<string>")))
    total = F.size(mine) + len(grams) - shared
    return F.when(total > 0, shared / total).otherwise(F.lit(0.0))
