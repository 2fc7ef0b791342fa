"""Substring deduplication by external suffix sorting in shards.

Every string of ``MIN_MATCH`` bytes is filed under the smallest hashed ``ANCHOR``-byte piece in it (the last of
equal ones), so equal strings are filed alike wherever they stand, and neighbouring strings mostly share a piece and
form one segment. Segments whose piece occurs once are done: nothing in them repeats. Segments that are equal as
a whole are counted, not gathered, so a group of copies costs one entry. What is left, different segments under one
piece, goes to shards by piece; each shard sorts its suffixes by external induction (``induced``) and every string
with an equal neighbour in that order is repeated. Bytes covered by repeated strings are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import dealt_anew, materialise
from marquee.llm.induced import repeated_starts

MIN_MATCH = 400
ANCHOR = 64
CHUNK = 1 << 20
SHARD_BYTES = 1 << 21       # text of one suffix sort, if its pieces allow
SHARD_BUDGET = 128 << 20    # memory of one suffix sort before its queue and runs go to disk
_POSITION_BITS = 22


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def piece_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` (a power of two) bytes, by doubling."""
    h, size, factor = _BYTE[data], 1, 0xD6E8FEB86659FD93
    while size < length:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor = factor * factor % 2**64
        size *= 2
    return _mix(h)


def segments(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, match: int = MIN_MATCH,
             anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of the texts data[begin:end] laid end to end: (text number, first string, strings, piece hash)."""
    empty = np.empty(0, dtype=np.int64)
    if len(data) < match:
        return empty, empty, empty, empty.view(np.uint64)
    hashes = piece_hashes(data, anchor)
    width = match - anchor + 1
    n = len(data) - match + 1
    places = np.arange(len(hashes), dtype=np.uint64)
    last = np.uint64((1 << _POSITION_BITS) - 1)
    # Smaller hash first, later place first among equal ones.
    values = (hashes >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | (last - places)
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = (last - (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & last)).astype(np.int64)
    edge = np.zeros(n + 1, dtype=np.int32)
    long = ends - begins >= match
    np.add.at(edge, begins[long], 1)
    np.add.at(edge, ends[long] - match + 1, -1)
    valid = np.flatnonzero(np.cumsum(edge[:n]) > 0)
    if not len(valid):
        return empty, empty, empty, empty.view(np.uint64)
    picked = chosen[valid]
    heads = np.flatnonzero(np.concatenate([[True], (np.diff(valid) != 1) | (np.diff(picked) != 0)]))
    first = valid[heads]
    counts = np.diff(np.append(heads, len(valid)))
    owner = np.searchsorted(begins, first, side="right") - 1
    # Texts without bytes begin where the next one does; the last of equal begins is the one that holds bytes.
    return owner, first, counts, hashes[picked[heads]]


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a column of texts; nulls are empty."""
    column = pa.array(column.fill_null(b"" if pa.types.is_binary(column.type) else ""))
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data, bounds


def _pieces(bounds: np.ndarray, match: int, chunk: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """Ranges of the laid-out texts to work on at once: (from, to, begins, ends, number of the first text)."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = i + 1
        while j < n and bounds[j + 1] - bounds[i] <= chunk:
            j += 1
        lo, hi = int(bounds[i]), int(bounds[j])
        if hi - lo <= chunk:
            yield lo, hi, bounds[i:j] - lo, bounds[i + 1:j + 1] - lo, i
        else:  # one long text, in overlapping parts
            for a in range(lo, max(lo + 1, hi - match + 1), chunk - match + 1):
                b = min(hi, a + chunk)
                yield a, b, np.array([0]), np.array([b - a]), i
        i = j


SEGMENT = "doc_id long, text_key long, first long, strings int, piece long, content long"


def _file_segments(match: int, anchor: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            data, bounds = _texts(batch.column(2))
            for lo, hi, begins, ends, base in _pieces(bounds, match, chunk):
                part = data[lo:hi]
                owner, first, strings, piece = segments(part, begins, ends, match, anchor)
                if not len(owner):
                    continue
                digest = xxhash.xxh3_64_intdigest
                buffer = memoryview(part)
                content = np.array([digest(buffer[a:a + s + match - 1]) for a, s in zip(first.tolist(), strings.tolist())],
                                   dtype=np.uint64)
                owners = pa.array(owner + base)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(owners), keys.take(owners), pa.array(first + lo - bounds[owner + base]),
                     pa.array(strings.astype(np.int32)), pa.array(piece.view(np.int64)), pa.array(content.view(np.int64))],
                    names=["doc_id", "text_key", "first", "strings", "piece", "content"])

    return run


def _cut_out(match: int):
    """The bytes of wanted segments, from the documents that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _texts(batch.column(2))
            wanted = batch.column(3).to_pylist()
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, segs in enumerate(wanted):
                base, raw = int(bounds[i]), []
                for s in segs:
                    raw.append(data[base + s["first"]:base + s["first"] + s["strings"] + match - 1].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s["piece"] for s in segs], pa.int64()), pa.array([ids[i]] * len(segs), pa.int64()),
                     pa.array([keys[i]] * len(segs), pa.int64()), pa.array([s["first"] for s in segs], pa.int64()),
                     pa.array(raw, pa.binary())],
                    names=["piece", "doc_id", "text_key", "first", "raw"])

    return run


def _repeated_in(names: list[tuple], parts: list[np.ndarray], match: int, budget: int) -> pa.RecordBatch:
    """Ranges of repeated strings in the segments of one shard, laid into one text whose suffixes are sorted."""
    sizes = np.array([len(p) for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.zeros(starts[-1] + 1, dtype=np.uint16)  # 0 ends the text, 1 a segment, bytes follow from 2
    for a, p in zip(starts.tolist(), parts):
        text[a:a + len(p)] = p
        text[a:a + len(p)] += 2
        text[a + len(p)] = 1
    flags = repeated_starts(text, 258, match, budget)
    out: list[tuple] = []
    for k, (name, size) in enumerate(zip(names, sizes.tolist())):
        for a, b in _runs(flags[starts[k]:starts[k] + size - match + 1]):
            out.append((*name[:2], name[2] + a, name[2] + b + match - 1))
    return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(4)],
                                      names=["doc_id", "text_key", "a", "b"])


def _sort_shard(match: int, shard_bytes: int, budget: int):
    """Repeated strings of a partition that is sorted by piece.

    Whole pieces are taken together until a shard holds ``shard_bytes``; a piece that holds more by itself is one
    shard, whose queue and runs may go beyond the memory budget; its segments and its text are held in memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, names, parts, held, last = set(), [], [], 0, None
        for batch in batches:
            pieces, ids, keys, firsts = (batch.column(i).to_pylist() for i in range(4))
            data, bounds = _texts(batch.column(4))
            for i, name in enumerate(zip(ids, keys, firsts)):
                if pieces[i] != last:
                    last = pieces[i]
                    if held >= shard_bytes:
                        yield _repeated_in(names, parts, match, budget)
                        seen, names, parts, held = set(), [], [], 0
                if name not in seen:  # a row that is there twice is one place here; its copies count as whole segments
                    seen.add(name)
                    names.append(name)
                    parts.append(data[bounds[i]:bounds[i + 1]].copy())
                    held += len(parts[-1])
        if parts:
            yield _repeated_in(names, parts, match, budget)

    return run


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of ones, as half-open ranges."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.asarray(flags) != 0, [0]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _drop_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = _texts(batch.column(1))
        spans_out, kept_out = [], []
        for i, spans in enumerate(batch.column(2).to_pylist()):
            raw = data[bounds[i]:bounds[i + 1]]
            merged: list[list[int]] = []
            for a, b in sorted((s["a"], s["b"]) for s in spans or []):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept.append(raw[at:a].tobytes())
                at = b
            kept_out.append(b"".join([*kept, raw[at:].tobytes()]))
            spans_out.append([{"a": a, "b": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(bounds)), pa.array(spans_out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
             pa.array(kept_out, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def byte_key(text: Column) -> Column:
    """Key of the bytes of a text; null and empty texts have the same."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_spans(docs: DataFrame, match: int = MIN_MATCH, anchor: int = ANCHOR, chunk: int = CHUNK,
                   shard_bytes: int = SHARD_BYTES, budget: int = SHARD_BUDGET) -> DataFrame:
    """(doc_id, text_key, a, b): byte ranges covered by strings of ``match`` bytes that also start elsewhere."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), byte_key(F.col("text")).alias("text_key"), "text")
    filed = rows.mapInArrow(_file_segments(match, anchor, chunk), SEGMENT)
    shared = filed.groupBy("piece").agg(F.count("*").alias("n")).where("n > 1").select("piece")
    segs = materialise(filed.join(dealt_anew(shared, "piece"), "piece"))
    one = F.struct("doc_id", "text_key", "first")
    kinds = segs.groupBy("piece", "content", "strings").agg(F.count("*").alias("copies"), F.min(one).alias("at"))
    end = F.col("first") + F.col("strings") + match - 1
    whole = (segs.join(kinds.where("copies > 1").select("piece", "content", "strings"), ["piece", "content", "strings"])
             .select("doc_id", "text_key", F.col("first").alias("a"), end.alias("b")))
    # Segments met once need sorting, and with them one of each other kind under the same piece.
    mixed = (kinds.groupBy("piece").agg(F.count("*").alias("kinds"), F.min("copies").alias("rarest"))
             .where("kinds > 1 and rarest = 1").select("piece"))
    wanted = (kinds.join(dealt_anew(mixed, "piece"), "piece").select("at.*", "strings", "piece")
              .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "strings", "piece")).alias("segs")))
    cut = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["text_key"] == wanted["text_key"])).select(
        rows["doc_id"], rows["text_key"], "text", "segs")
    cut = cut.mapInArrow(_cut_out(match), "piece long, doc_id long, text_key long, first long, raw binary")
    sorted_spans = cut.repartition("piece").sortWithinPartitions("piece").mapInArrow(
        _sort_shard(match, shard_bytes, budget), "doc_id long, text_key long, a long, b long")
    return whole.unionByName(sorted_spans)


def dedup_substrings(docs: DataFrame, match: int = MIN_MATCH, anchor: int = ANCHOR, chunk: int = CHUNK,
                     shard_bytes: int = SHARD_BYTES, budget: int = SHARD_BUDGET) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (removed byte ranges, merged) and kept (what remains).

    Reads ``doc_id`` and ``text``; other columns are ignored. Texts are UTF-8 bytes, a null one is empty; a removed
    range may cut a character, so ``kept`` is binary. Texts shorter than ``match`` stay as they are. Rows that
    repeat an id and a text are copies of each other. An empty table gives an empty result.
    """
    spans = (repeated_spans(docs, match, anchor, chunk, shard_bytes, budget).groupBy("doc_id", "text_key")
             .agg(F.collect_set(F.struct("a", "b")).alias("spans")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), byte_key(F.col("text")).alias("text_key"), "text")
    marked = rows.join(spans, rows["doc_id"].eqNullSafe(spans["doc_id"]) & (rows["text_key"] == spans["text_key"]), "left")
    return marked.select(rows["doc_id"], "text", "spans").mapInArrow(
        _drop_spans, "doc_id long, n_bytes long, spans array<struct<a:long,b:long>>, kept binary")
