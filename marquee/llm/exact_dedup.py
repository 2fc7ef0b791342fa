"""Exact deduplication with a cuckoo-filter index over live digests.

Texts are equal when they are identical without white space. Each task first runs an index over its own rows, so
that a group of copies reaches the next step as one entry per task however large it is; the entries then meet by
digest, where an index per bucket of digests elects the row that stays. The rows learn the outcome by a join that
the engine may split when one digest holds many of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import SPACE_CLASS, materialise, text_key

SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """Digests in a cuckoo filter with their stored keys beside it.

    ``table`` holds 16-bit tags, four to a bucket; a digest may lie in either of two buckets, and the second
    follows from the first and the tag. A tag that is found is only a hint: the stored keys of the index decide.
    When an insertion moves tags about for too long, the table doubles and is filled anew from the stored keys.
    """

    def __init__(self, buckets: int = 256):
        self.buckets = 1 << max(1, (buckets - 1).bit_length())
        self.table = [0] * (self.buckets * SLOTS)
        self.keys: dict[bytes, tuple] = {}
        self.resizes = 0
        self.false_hits = 0

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[:2], "little") or 1
        mask = self.buckets - 1
        first = int.from_bytes(digest[2:10], "little") & mask
        return tag, first, first ^ (tag * 0x5BD1E995 & mask)

    def _maybe(self, tag: int, first: int, second: int) -> bool:
        table = self.table
        return tag in table[first * SLOTS:first * SLOTS + SLOTS] or tag in table[second * SLOTS:second * SLOTS + SLOTS]

    def find(self, digest: bytes) -> tuple | None:
        """The payload of a live digest; a hit of the filter is verified against the stored key."""
        if not self._maybe(*self._place(digest)):
            return None
        payload = self.keys.get(digest)
        self.false_hits += payload is None
        return payload

    def _put(self, digest: bytes) -> bool:
        tag, first, second = self._place(digest)
        table, mask = self.table, self.buckets - 1
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not table[slot]:
                    table[slot] = tag
                    return True
        bucket = second
        for kick in range(MAX_KICKS):
            slot = bucket * SLOTS + (kick * 7 + tag) % SLOTS
            table[slot], tag = tag, table[slot]
            bucket ^= tag * 0x5BD1E995 & mask
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not table[free]:
                    table[free] = tag
                    return True
        return False

    def _grow(self) -> None:
        while True:
            self.buckets *= 2
            self.resizes += 1
            self.table = [0] * (self.buckets * SLOTS)
            if all(self._put(digest) for digest in self.keys):
                return

    def set(self, digest: bytes, payload: tuple) -> None:
        """Insert a digest, or replace the payload of a live one."""
        known = digest in self.keys
        self.keys[digest] = payload
        if not known and not self._put(digest):
            self._grow()

    def delete(self, digest: bytes) -> bool:
        """Take a live digest out of the filter and the stored keys; False if it was not live."""
        if self.find(digest) is None:
            return False
        del self.keys[digest]
        tag, first, second = self._place(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.table[slot] == tag:
                    self.table[slot] = 0
                    return True
        raise AssertionError("a live digest has no tag")


ENTRY = "digest binary, n_chars long, keep_id long, keep_text long, keep_row long, group_size long"


def normal_text(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", "")


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(normal_text(text), 256))


def _rank(entry: tuple) -> tuple:
    """More characters, then the smaller id, a null id behind all others; rows that repeat an id by text and row number."""
    chars, keep, text, row = entry[:4]
    return -chars, keep is None, keep or 0, text, row


def _elect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of one task, one per live digest."""
    index = CuckooIndex()
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for digest, *entry, size in zip(*columns):
            live = index.find(digest)
            if live is None:
                index.set(digest, (*entry, size))
            else:
                best = min(live[:4], tuple(entry), key=_rank)
                index.set(digest, (*best, live[4] + size))
    yield from _entries(index)


def _entries(index: CuckooIndex, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    items = list(index.keys.items())
    for start in range(0, len(items), rows):
        part = items[start:start + rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _ in part], pa.binary()),
                *(pa.array([p[i] for _, p in part], pa.int64()) for i in range(5)),
            ],
            names=[f.split()[0] for f in ENTRY.split(", ")],
        )


def build_index(rows: DataFrame) -> DataFrame:
    """One entry (as ENTRY) per distinct digest of rows (digest, n_chars, doc_id, text_key, row)."""
    entries = rows.select("digest", F.col("n_chars").cast("long"), F.col("doc_id").cast("long").alias("keep_id"),
                          F.col("text_key").alias("keep_text"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("group_size"))
    local = entries.mapInArrow(_elect, ENTRY)
    return local.repartition("digest").mapInArrow(_elect, ENTRY)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one task after its changes, insertions first, so that a delete never meets a missing digest."""
    index, removals = CuckooIndex(), []
    for batch in batches:
        for digest, change in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if change < 0:
                removals.append((digest, -change))
                continue
            live = index.find(digest)
            index.set(digest, ((live[0] if live else 0) + change,))
    for digest, change in removals:
        live = index.find(digest)
        if live is not None and live[0] > change:
            index.set(digest, (live[0] - change,))
        elif live is not None:
            index.delete(digest)
    items = list(index.keys.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in items], pa.binary()), pa.array([p[0] for _, p in items], pa.int64())],
        names=["digest", "n_docs"],
    )


def maintain(index: DataFrame, added: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """The live digests after a batch of changes, as (digest, n_docs).

    ``index`` is an earlier result (digest, n_docs); ``added`` and ``withdrawn`` are rows with ``text``. A digest
    leaves the index with its last document; withdrawing what is not live changes nothing. Changes combine
    before the shuffle, so a digest that changes a million times arrives as one row per task.
    """
    def counted(rows: DataFrame, sign: int) -> DataFrame:
        return (rows.select(text_digest(F.col("text")).alias("digest")).groupBy("digest")
                .agg((F.count("*") * sign).alias("change")))

    changes = (index.select("digest", F.col("n_docs").alias("change"))
               .unionByName(counted(added, 1)).unionByName(counted(withdrawn, -1)))
    return changes.repartition("digest").mapInArrow(_apply, "digest binary, n_docs long")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the row of its group of equal texts that stays.

    Reads ``doc_id`` and ``text`` and ignores all other columns. Returns doc_id, keep_id, group_size, kept,
    text_sha256. Of equal texts the one with the most code points stays, then the smallest doc_id (a null id last).
    Null texts count as empty and equal each other. Exactly one row of a group stays: of rows that repeat the id one
    text's, and of rows that repeat both any one, as they are alike; each counts in group_size. An empty table gives an
    empty result.
    """
    # Row numbers must not change between the two uses: lean rows, written once.
    rows = materialise(docs.select("doc_id", text_digest(F.col("text")).alias("digest"), text_key(F.col("text")).alias("text_key"),
                                   F.length(F.coalesce("text", F.lit(""))).alias("n_chars"),
                                   F.monotonically_increasing_id().alias("row")))
    index = build_index(rows).select("digest", "keep_id", "keep_row", "group_size")
    return rows.select("doc_id", "digest", "row").join(index, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
