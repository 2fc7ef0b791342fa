"""Benchmark decontamination with DataFrame functions only.

Every window of 13 consecutive words of a benchmark item becomes a hash in a broadcast table; every word window of
every document is hashed where the document lies and probes it, and only a hit compares the words themselves.
Documents are never shuffled: what moves are the verified hits and one narrow row per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import alnum_words, let, same_row, same_text, text_key

WINDOW = 13
MAX_BROADCAST_WINDOWS = 1_000_000


def window_hashes(words: Column, length: int) -> Column:
    """Hash of each run of ``length`` words, in order; an empty array if there are fewer words."""
    def of(hashes: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(hashes) - length + 1),
                            lambda i: F.xxhash64(F.slice(hashes, i, length)))
        return F.when(F.size(hashes) >= length, grams).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows (h, len, words, item_ids) of the items; an item shorter than a window is one window.

    Items without words have none. Rows that share an item_id are one item; a null item_id gives windows that hit
    but no id to report.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), alnum_words(F.col("text")).alias("words"))
    size = F.least(F.size("words"), F.lit(WINDOW))
    cut = items.where(F.size("words") > 0).select(
        "item_id", size.alias("len"),
        F.explode(let(F.col("words"), lambda ws: F.transform(
            F.sequence(F.lit(1), F.size(ws) - F.least(F.size(ws), F.lit(WINDOW)) + 1),
            lambda i: F.slice(ws, i, F.least(F.size(ws), F.lit(WINDOW)))))).alias("w"))
    return (cut.select("item_id", "len", F.array_join("w", " ").alias("words"),
                       F.xxhash64(F.transform("w", lambda x: F.xxhash64(x))).alias("h"))
            .groupBy("h", "len", "words").agg(F.collect_set("item_id").alias("item_ids")))


def document_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified occurrences (doc_id, text_key, at, len, item_ids) of benchmark windows; words count from 0.

    The benchmark's windows are counted first: up to MAX_BROADCAST_WINDOWS they are broadcast, beyond that the
    join shuffles hashes.
    """
    windows = item_windows(benchmark)
    seen = windows.agg(F.count("*").alias("n"), F.collect_set("len").alias("lens")).first()  # at most 13 lengths
    lens = sorted(seen["lens"], reverse=True) or [WINDOW]
    wanted = windows.select("h", F.col("len").alias("w_len"), F.col("words").alias("w_words"), "item_ids")
    tokens = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), alnum_words(F.col("text")).alias("words"))
    # The hashes of all lengths lie one after the other; the place tells which is which.
    grams = tokens.select("doc_id", "text_key", "words", F.size("words").alias("n"),
                          F.concat(*[window_hashes(F.col("words"), n) for n in lens]).alias("grams"))
    at, start = F.lit(None).cast("int"), F.lit(0)
    for n in lens:
        count = F.greatest(F.col("n") - n + 1, F.lit(0))
        here = (F.col("place") >= start) & (F.col("place") < start + count)
        at, start = F.coalesce(F.when(here, F.col("place") - start), at), start + count
    facts = [at.alias("at"), "w_len", "w_words", "item_ids"]
    if seen["n"] <= MAX_BROADCAST_WINDOWS:
        spread = grams.select("doc_id", "text_key", "words", "n", F.posexplode_outer("grams").alias("place", "h"))
        hits = spread.join(F.broadcast(wanted), "h").select("doc_id", "text_key", "words", *facts)
    else:
        # The words of a document must not travel with each of its windows: they meet the hits by document.
        spread = grams.select("doc_id", "text_key", "n", F.posexplode_outer("grams").alias("place", "h"))
        found = spread.join(wanted, "h").select("doc_id", "text_key", *facts)
        own = tokens.dropDuplicates(["doc_id", "text_key"])
        hits = found.join(own, same_row(found, own)).select(found["doc_id"], found["text_key"], "words", "at", "w_len", "w_words", "item_ids")
    found_words = F.array_join(F.slice("words", F.col("at") + 1, F.col("w_len")), " ")
    return hits.where(same_text(found_words, F.col("w_words"))).select(
        "doc_id", "text_key", "at", F.col("w_len").alias("len"), "item_ids")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated, and
    ``hit_words``, the places of the words that lie in a benchmark window (null without any).

    Reads ``doc_id`` and ``text`` of documents, ``item_id`` and ``text`` of the benchmark; other columns are
    ignored. Null and empty texts have no words and are clean. Rows that repeat an id and a text get the same
    result each. An empty benchmark leaves all documents clean.
    """
    found = document_hits(docs, benchmark).groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("at", "len")).alias("spots"), F.flatten(F.collect_set("item_ids")).alias("ids"))
    places = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "spots", lambda s: F.sequence(s["at"], s["at"] + s["len"] - 1)))))
    found = found.select("doc_id", "text_key", places.alias("hit_words"), F.array_sort(F.array_distinct("ids")).alias("ids"))
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"),
                       F.size(alnum_words(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.when(F.col("hit_words").isNull(), F.lit(0)).otherwise(F.size("hit_words")).cast("long")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return rows.join(found, same_row(rows, found), "left").select(
        rows["doc_id"], rows["text_key"], "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "hit_words")


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    dirty = contamination(docs, benchmark).where("contaminated").select("doc_id", "text_key").distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id",
                      text_key(F.col("text")).alias("text_key"))
    return row.join(dirty, same_row(row, dirty), "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text) with every word that lies in a benchmark window taken out, separators before it included."""
    marked = contamination(docs, benchmark).where("n_hit > 0").select("doc_id", "text_key", "hit_words").dropDuplicates(
        ["doc_id", "text_key"])
    rows = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    pieces = F.regexp_extract_all("text", F.lit(f"{gap}{word}"), F.lit(0))
    tail = F.regexp_extract("text", gap + r"\z", 0)
    left = let(pieces, lambda p: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(p) - 1), F.col("hit_words")), lambda i: F.get(p, i)), ""))
    return rows.join(marked, same_row(rows, marked), "left").select(
        rows["doc_id"], F.when(F.col("hit_words").isNull(), F.col("text")).otherwise(F.concat(left, tail)).alias("text"))
