"""Line deduplication by winnowing over line hashes, with DataFrame functions only.

A run of consecutive lines counts as repeated if it has ``run`` lines, or fewer lines with ``long`` characters together
(one long line, say), and stands earlier in document order as well. The first stays, the lines of all later ones go.

1. Winnowing: of every ``run - gram + 1`` consecutive groups of ``gram`` lines the one with the smallest hash is selected, so two
   places that share ``run`` lines both select the same group of them. Long groups of fewer lines are selected as they are.
2. Positions are joined by fingerprint; fingerprints that stand at one place only are dropped.
3. A match is extended both ways from its fingerprint, line by line, until it has ``run`` lines: each reach (so many lines before, the
   rest behind) is compared with the first place that has the same. Where a match goes on beyond that, the next
   selected group lies inside it and carries it further, so a match ends where its lines end, and no pair of places is formed.

Lines and runs are compared by a 64-bit and a further 32-bit hash of other making.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import dealt_anew, let, same_row, text_key

RUN = 3            # lines of the shortest run that counts as repeated whatever its length
GRAM = 2           # lines of a fingerprint
LONG = 200         # characters (without line feeds) from which fewer lines count as well


def fingerprints(text: Column, run: int, gram: int, long: int) -> Column:
    """Array of (fp, at, spans): the selected groups of lines of a text, each with the runs it can be extended to.

    A span is (start, length, key, check): the place and number of its lines and their two hashes.
    """

    def of(x: Column) -> Column:
        hashes, others, sizes = x["hashes"], x["others"], x["sizes"]
        n = F.size(hashes)
        places = F.transform(hashes, lambda h, i: i)

        def key(at: Column, length: int) -> Column:
            return F.xxhash64(F.slice(hashes, at + 1, length))

        def span(at: Column, length: int) -> Column:
            return F.struct(at.alias("start"), F.lit(length).alias("length"), key(at, length).alias("key"),
                            F.hash(F.slice(others, at + 1, length)).alias("check"))

        def extended(at: Column) -> Column:
            starts = F.transform(F.array(*[F.lit(k) for k in range(run - gram + 1)]), lambda back: at - back)
            return F.transform(F.filter(starts, lambda s: (s >= 0) & (s <= n - run)), lambda s: span(s, run))

        def winnowed(groups: Column) -> Column:
            least = F.transform(F.filter(places, lambda j: j <= n - run),
                                lambda j: F.array_min(F.slice(groups, j + 1, run - gram + 1))["back"])
            return F.transform(F.array_distinct(least), lambda back: F.struct(
                F.get(groups, -back)["fp"].alias("fp"), (-back).alias("at"), extended(-back).alias("spans")))

        def short_and_long(length: int) -> Column:
            size = lambda i: reduce(Column.__add__, [F.get(sizes, i + k) for k in range(length)])
            return F.transform(F.filter(places, lambda i: (i <= n - length) & (size(i) >= long)), lambda i: F.struct(
                key(i, length).alias("fp"), i.alias("at"), F.array(span(i, length)).alias("spans")))

        groups = F.transform(F.filter(places, lambda i: i <= n - gram),
                             lambda i: F.struct(key(i, gram).alias("fp"), (-i).alias("back")))
        return F.concat(let(groups, winnowed), *[short_and_long(length) for length in range(1, run)])

    return let(let(F.split(text, "\n"), lambda lines: F.struct(
        F.transform(lines, lambda x: F.xxhash64(x)).alias("hashes"), F.transform(lines, lambda x: F.hash(x)).alias("others"),
        F.transform(lines, lambda x: F.length(x)).alias("sizes"))), of)


def repeated_lines(docs: DataFrame, run: int = RUN, gram: int = GRAM, long: int = LONG) -> DataFrame:
    """(doc_id, text_key, lines): for each document with repeated runs, the sorted places of the lines to delete.

    The order is by doc_id (null ids last), then a key of the text, then line. Within one document a run repeats an earlier one
    only if they do not overlap, so the first of a line that is repeated many times over stays for ``run`` lines.
    """
    positions = (docs.where("text is not null").select("doc_id", text_key(F.col("text")).alias("text_key"),
                                                       F.explode(fingerprints(F.col("text"), run, gram, long)).alias("f"))
                 .select("doc_id", "text_key", "f.fp", "f.at", "f.spans"))
    place = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "text_key", "at")
    shared = (positions.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("b"))
              .where("a <> b").select("fp"))
    spans = (positions.join(dealt_anew(shared, "fp"), "fp").select("doc_id", "text_key", F.explode("spans").alias("s"))
             .select("doc_id", "text_key", "s.*"))
    start = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "text_key", "start")
    firsts = spans.groupBy("key", "check", "length").agg(F.min(start).alias("first"))
    later = spans.join(dealt_anew(firsts, "key"), ["key", "check", "length"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")))
        | (F.col("first.start") + F.col("length") <= F.col("start")))
    lines = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "found", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))))
    return (later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("found"))
            .select("doc_id", "text_key", lines.alias("lines")))


def dedup_lines(docs: DataFrame, run: int = RUN, gram: int = GRAM, long: int = LONG) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (without later repeated runs), n_lines, n_removed, n_runs.

    Reads ``doc_id`` and ``text``; other columns are ignored. Lines end at a line feed and are compared as they are;
    a null text stays null and has no lines, an empty one has one empty line. Rows that repeat an id and a text are
    one document: they get the same result and are not each other's copies.
    """
    rows = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    gone = repeated_lines(docs, run, gram, long)
    left = let(F.split("text", "\n"), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("lines")), lambda i: F.get(x, i)), "\n"))
    n_removed = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    follows = F.size(F.array_intersect("lines", F.transform("lines", lambda i: i + 1)))
    return rows.join(gone, same_row(rows, gone), "left").select(
        rows["doc_id"], F.when(F.col("lines").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        n_removed.cast("long").alias("n_removed"),
        F.when(F.col("lines").isNull(), 0).otherwise(n_removed - follows).cast("long").alias("n_runs"))
