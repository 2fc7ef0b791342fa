"""SimHash near-duplicates through pivot distance tables.

A document's fingerprint is the bitwise majority of the hashes of its shingles. Two fingerprints within a few bits
of each other differ in few of the blocks that the 64 bits are cut into, so they agree on all others: a cell of the
table is the choice of agreeing blocks and their bits. Within a cell, fingerprints can differ only in the chosen
blocks; there the distances to many pivots (reference fingerprints) are computed once, sorted by the first pivot,
and a pair whose distances to any pivot differ by more than the bound is discarded (the triangle inequality); the
few that survive are verified by their own distance. Equal fingerprints are merged before, and a cell holds at most
2 ** (bits of the open blocks) of them, so no cell grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialise, same_row, smallest_reachable, text_key

BITS = 64
BLOCKS = 8
PIVOTS = 24
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority fingerprint of one text, as an unsigned integer."""
    if not text:
        return 0
    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype=np.uint64)
    # Bit counts a slice at a time, so that a very long text needs no more memory than a short one.
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 65_536):
        part = hashes[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_key, fp) of every row; fp holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _block_masks(blocks: int) -> list[int]:
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def pivot_links(fps: np.ndarray, max_bits: int, pivots: np.ndarray) -> list[tuple[int, int]]:
    """Links within ``max_bits`` among distinct fingerprints, as positions; enough of them to connect what connects.

    The table has a row per fingerprint and a column per pivot. Rows are sorted by the first column, so partners of
    a row lie in a stretch; the other columns discard, the exact distance decides. A pair that is already connected
    needs no further link, so the result never exceeds one link per fingerprint.
    """
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    ends = np.searchsorted(table[:, 0], table[:, 0] + max_bits, side="right")
    root = np.arange(len(fps))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i in range(len(fps) - 1):
        lo, hi = i + 1, int(ends[i])
        if lo >= hi:
            continue
        near = lo + np.flatnonzero((np.abs(table[lo:hi] - table[i]) <= max_bits).all(axis=1))
        near = near[np.bitwise_count(fps[near] ^ fps[i]) <= max_bits]
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(order[i]), int(order[j])))
    return links


def near_links(distinct: DataFrame, max_bits: int, blocks: int = BLOCKS, pivots: int = PIVOTS, seed: int = 29) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp``, connecting all that lie within ``max_bits`` of each other."""
    masks = _block_masks(blocks)
    opened = [sum(masks[i] for i in choice) for choice in combinations(range(blocks), max_bits)]
    cells = F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(~mask & (2**BITS - 1)))).alias("bits"))
        for i, mask in enumerate(opened)
    ])
    table = np.random.default_rng(seed).integers(0, 2**BITS, size=pivots, dtype=np.uint64)

    def link(column: pd.Series) -> pd.Series:
        out = []
        for cell in column:
            fps = np.asarray(cell, dtype=np.int64)
            out.append([{"a": int(fps[i]), "b": int(fps[j])} for i, j in pivot_links(fps.view(np.uint64), max_bits, table)])
        return pd.Series(out)

    link_udf = F.pandas_udf(link, "array<struct<a:long,b:long>>")
    grouped = (distinct.select("fp", F.explode(cells).alias("cell")).select("fp", "cell.choice", "cell.bits")
               .repartition("choice", "bits").groupBy("choice", "bits")
               .agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))
    return grouped.select(F.explode(link_udf("fps")).alias("l")).select("l.a", "l.b").distinct()


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Every row's fingerprint and the smallest doc_id it is connected to.

    Reads ``doc_id`` and ``text`` and ignores other columns. Returns doc_id, text_key, fingerprint (16 hex
    digits), component_id, group_id (the smallest fingerprint of the component). Words are what white space separates, with
    A-Z in lower case; shingles repeat; a text of fewer words is one shingle; a text without words, or a null one,
    has fingerprint zero and links like any other. A bit is set if it is in over half the shingles. Rows that share
    a fingerprint link; null ids never become a component_id unless nothing else is in the component.
    """
    # Three narrow columns a row, used for the groups and for the result: written once, so texts are read once.
    fps = materialise(with_fingerprints(docs, shingle))
    # One row per fingerprint: a group of copies is one entry whatever its size.
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = near_links(distinct.select("fp"), max_bits)
    roots = smallest_reachable(docs.sparkSession, links)
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    firsts = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(firsts, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.lower(F.lpad(F.hex("root"), 16, "0")).alias("group_id"))


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs``, all columns, of each group: that of the smallest doc_id (null ids last, then by text)."""
    found = simhash_components(docs, shingle, max_bits)
    stays = found.groupBy("group_id").agg(F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "text_key")).alias("s"))
    stays = stays.select("s.doc_id", "s.text_key")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      text_key(F.col("text")).alias("text_key"))
    kept = row.join(stays, same_row(row, stays), "left_semi")
    return kept.dropDuplicates(["doc_id", "text_key"]).select("row.*")
