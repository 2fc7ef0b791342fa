"""Title and name search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import text as X
from marquee.functions.columns import let


def phrase_search(df: DataFrame, column: str, phrase: str) -> DataFrame:
    """Rows whose text holds the phrase as whole words."""
    return df.filter(X.phrase_match(F.col(column), phrase))


def token_search(df: DataFrame, column: str, query: str, score: str = "score") -> DataFrame:
    """Rows holding any word of the query, with the number of distinct words held."""
    return df.withColumn(score, X.token_score(F.col(column), query)).filter(F.col(score) > 0)


def ilike_search(df: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose text holds ``part`` anywhere, case ignored. Pattern characters count as text."""
    escaped = part.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return df.filter(F.col(column).ilike(f"%{escaped}%"))


def similar(df: DataFrame, column: str, term: str, threshold: float = 0.3, score: str = "similarity") -> DataFrame:
    """Rows whose trigram similarity to ``term`` reaches the threshold."""
    return df.withColumn(score, X.trigram_similarity(F.col(column), term)).filter(F.col(score) >= threshold)


def similar_to_terms(
    df: DataFrame, key: str, column: str, terms: DataFrame, term: str, threshold: float = 0.3,
) -> DataFrame:
    """Match each row's text against search terms by trigram similarity.

    Of a text with n trigrams a term must hold at least ``threshold * n``, so texts with fewer trigrams of any term
    leave first. What is left puts its trigrams in one order, rare among the terms first: two sets that reach the
    threshold share one of the first few of each, so only those meet, if the sizes of the sets and what lies behind the
    place of the meeting still allow it. The similarity is then computed in full. ``key`` identifies a row. Result:
    key, column, term, similarity.
    """
    if threshold <= 0:
        raise ValueError("threshold must be above 0")
    words = terms.select(F.col(term).alias("term")).distinct().select("term", X.trigrams(F.col("term")).alias("_w"))
    spread = words.select("term", F.size("_w").alias("_m"), F.explode_outer("_w").alias("_gram")).where("_gram is not null")
    ranked = F.sort_array(F.collect_list(F.struct("_df", "_gram")))["_gram"]
    # How many terms hold each trigram; those of no term cannot match.
    vocabulary = spread.groupBy("_gram").agg(F.count(F.lit(1)).alias("_df"))
    known = spread.withColumn("_df", F.count(F.lit(1)).over(Window.partitionBy("_gram"))).groupBy("term", "_m").agg(ranked.alias("_w"))
    asked = known.select("*", prefix("_w", "_m", threshold).alias("_q")).select("*", F.posexplode("_q").alias("_j", "_gram"))

    # The sketch knows every trigram of the vocabulary and takes a few others for one, so it lets through too much, never too little.
    def possible(grams: Column) -> Column:
        may = F.filter(grams, lambda g: in_sketch(g, F.col("_bits")))
        return F.when(F.size(may) >= least_shared(F.size(grams), threshold), grams)

    texts = df.withColumn("_bits", sketch(vocabulary, "_gram").scalar()).select(
        key, column, let(X.trigrams(F.col(column)), possible).alias("_g"))
    held = texts.select(key, column, F.size("_g").alias("_n"), F.explode_outer("_g").alias("_gram")).join(vocabulary, "_gram").groupBy(
        key, column, "_n").agg(ranked.alias("_h")).where(F.size("_h") >= least_shared(F.col("_n"), threshold))
    tried = held.select("*", prefix("_h", "_n", threshold).alias("_p")).select("*", F.posexplode("_p").alias("_i", "_gram"))

    met = tried.join(asked, "_gram").where(
        (F.col("_m") >= least_shared(F.col("_n"), threshold)) & (F.col("_n") >= least_shared(F.col("_m"), threshold))
        & (F.least(F.size("_h") - F.col("_i"), F.size("_w") - F.col("_j")) >= least_common("_n", "_m", threshold))
        & (F.get(F.array_intersect("_p", "_q"), F.lit(0)) == F.col("_gram")))  # a pair counts where it meets first
    shared = F.size(F.array_intersect("_h", "_w"))
    similarity = shared / (F.col("_n") + F.col("_m") - shared)
    return met.select(key, column, "term", similarity.alias("similarity")).filter(F.col("similarity") >= threshold)


# Bits of a sketch of a vocabulary: 8 KB, whatever the vocabulary holds.
SKETCH_BITS = 1 << 16


def _bit(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(SKETCH_BITS)).cast("int")


def sketch(df: DataFrame, column: str) -> DataFrame:
    """One row with a bitmap of the hashes of ``column``, as longs of 64 bits; a table beyond its size sets all bits."""
    bits = df.select(_bit(F.col(column)).alias("b")).select(
        F.shiftright("b", 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b").bitwiseAND(63)).alias("v"))
    words = bits.groupBy("at").agg(F.bit_or("v").alias("v"))
    known = words.agg(F.map_from_entries(F.collect_list(F.struct("at", "v"))).alias("m"))
    return known.select(F.transform(F.sequence(F.lit(0), F.lit(SKETCH_BITS // 64 - 1)),
                                    lambda i: F.coalesce(F.element_at("m", i), F.lit(0).cast("long"))))


def in_sketch(value: Column, words: Column) -> Column:
    """Whether the bit of ``value`` is set: surely so if the vocabulary holds it."""
    return F.getbit(F.get(words, F.shiftright(_bit(value), 6)), _bit(value).bitwiseAND(63)) == 1


# Thresholds are binary fractions: what they ask for is taken a little lower, never higher.
SLACK = 1e-9


def least_shared(size: Column, threshold: float) -> Column:
    """Elements that a set of ``size`` shares at least with any set that reaches the Jaccard ``threshold``."""
    return F.ceil(size * threshold - SLACK)


def least_common(n: str, m: str, threshold: float) -> Column:
    """Elements that two sets of sizes ``n`` and ``m`` share at least if they reach the ``threshold``."""
    return F.ceil((F.col(n) + F.col(m)) * (threshold / (1 + threshold)) - SLACK)


def prefix(grams: str, size: str, threshold: float) -> Column:
    """The first elements of a sorted set, of which two sets that reach the ``threshold`` share at least one.

    ``grams`` may leave out elements that are in no other set; they count as first, ``size`` counts them.
    """
    return F.slice(grams, F.lit(1), F.greatest(F.size(grams) - least_shared(F.col(size), threshold) + 1, F.lit(0)).cast("int"))


def aka_lookup(titles: DataFrame, akas: DataFrame, title: str) -> DataFrame:
    """Titles known under an exact alternative title, each once."""
    hits = akas.filter(F.col("title") == title).select(F.col("titleId").alias("tconst"))
    return titles.join(hits, "tconst", "left_semi")
