"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): the pairwise interactions of all
features at rank ``RANK``, in time linear in the features of a document. The machine is fitted in one task on the sparse features of a bounded, seeded sample of labelled
documents; only its weights reach the driver. Every document is scored where it lies, and the weights are the only
thing sent to the tasks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_BITS = 14
RANK = 4
MAX_FIT_ROWS = 6000
THRESHOLD = 0.3

# Byte classes of the structure statistics.
_CLASS = np.full(256, 4, dtype=np.uint8)          # 4: punctuation and control characters
_CLASS[[9, 10, 11, 12, 13, 32]] = 0               # 0: white space
_CLASS[48:58] = 1                                 # 1: digits
_CLASS[65:91] = 2                                 # 2: upper case
_CLASS[97:123] = 3                                # 3: lower case
_CLASS[128:] = 5                                  # 5: beyond ASCII
STATS = 16
N_FEATURES = (1 << HASH_BITS) + STATS


def features(text: str | None, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of one text: positions, values. A null or empty text has its structure statistics only."""
    raw = (text or "").encode("utf-8")
    data = np.frombuffer(raw, dtype=np.uint8)
    n = max(1, len(data))
    kinds = np.bincount(_CLASS[data], minlength=6)
    lines = raw.split(b"\n")
    words = raw.lower().split()
    counted = Counter(words)
    n_words = max(1, len(words))
    marks = np.bincount(data, minlength=128)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    top = max(counted.values(), default=0)
    stats = np.array([
        1.0, *(kinds / n), np.log1p(len(raw)) / 12, np.log1p(len(words)) / 10,
        len(raw) / n_words / 20, len(counted) / n_words, repeats / n_words, top / n_words,
        (marks[33] + marks[35] + marks[36] + marks[37] + marks[38] + marks[42]) / n_words,
        marks[124] / n_words, min(1.0, len(lines) / n_words),
    ])
    buckets = np.empty(len(counted), dtype=np.int64)
    for i, w in enumerate(counted):
        at = cache.get(w)
        if at is None:
            at = zlib.crc32(w) & ((1 << HASH_BITS) - 1)
            if len(cache) < 100_000:
                cache[w] = at
        buckets[i] = at
    values = np.log1p(np.fromiter(counted.values(), dtype=np.float64, count=len(counted)))
    spots, inverse = np.unique(buckets, return_inverse=True)
    merged = np.bincount(inverse, weights=values, minlength=len(spots))
    norm = np.sqrt((merged**2).sum()) or 1.0
    return (np.concatenate([spots, (1 << HASH_BITS) + np.arange(STATS)]),
            np.concatenate([merged / norm, 3 * stats]))


def _raw_scores(w0: float, w: np.ndarray, v: np.ndarray, spots: np.ndarray, values: np.ndarray, starts: np.ndarray):
    """Machine output of documents laid end to end, and the sums needed for its gradient."""
    linear = np.add.reduceat(w[spots] * values, starts)
    xv = v[spots] * values[:, None]
    sums = np.add.reduceat(xv, starts)
    squares = np.add.reduceat((xv * xv).sum(axis=1), starts)
    return w0 + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums, xv


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64,
        rate: float = 0.08, decay: float = 1e-5, seed: int = 5) -> tuple[float, np.ndarray, np.ndarray]:
    """AdaGrad on the logistic loss. The same rows in the same order give the same machine."""
    rng = np.random.default_rng(seed)
    w0, w, v = 0.0, np.zeros(N_FEATURES), rng.normal(0, 0.02, (N_FEATURES, RANK))
    if not rows:
        return w0, w, v
    g0, gw, gv = 1e-8, np.full(N_FEATURES, 1e-8), np.full((N_FEATURES, RANK), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            lengths = np.array([len(rows[i][0]) for i in part])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            spots = np.concatenate([rows[i][0] for i in part])
            values = np.concatenate([rows[i][1] for i in part]).astype(np.float64)
            out, sums, xv = _raw_scores(w0, w, v, spots, values, starts)
            err = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - labels[part]) / len(part)
            each = np.repeat(err, lengths)
            touched, where = np.unique(spots, return_inverse=True)
            dw = np.bincount(where, weights=each * values) + decay * w[touched]
            slope = (each * values)[:, None] * (np.repeat(sums, lengths, axis=0) - xv)
            dv = np.stack([np.bincount(where, weights=slope[:, f]) for f in range(RANK)], axis=1) + decay * v[touched]
            d0 = err.sum()
            g0 += d0 * d0
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            w0 -= rate * d0 / np.sqrt(g0)
            w[touched] -= rate * dw / np.sqrt(gw[touched])
            v[touched] -= rate * dv / np.sqrt(gv[touched])
    return w0, w, v


def held_out(doc_id) -> F.Column:
    """The fold that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, seed: int = 11):
    """A machine fitted on at most ``max_rows`` labelled documents outside the held-out fold.

    The sample is the labelled ids with the smallest seeded hashes. Null labels and ids are passed over; an id with
    several labels counts by their mean; an id on several documents gives several rows, ``max_rows`` in all.
    """
    known = (labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
             .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_rows))
    picked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most max_rows ids

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for b in batches:
            for i in range(b.num_rows):
                spots, values = features(b.column(1)[i].as_py(), cache)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1), pa.array([b.column(2)[i].as_py()], pa.int32()),
                     pa.array([spots.tolist()], pa.list_(pa.int32())), pa.array([values.tolist()], pa.list_(pa.float32()))],
                    names=["doc_id", "quality", "spots", "values"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, qualities = [], []
        for b in batches:
            spots, values = (np.asarray(b.column(k).flatten()) for k in (2, 3))
            ends = np.cumsum(np.asarray(b.column(2).value_lengths()))
            rows += [(spots[i:j], values[i:j]) for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]
            qualities += b.column(1).to_pylist()
        w0, w, v = fit(rows, np.array(qualities, dtype=np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([float(w0)]), pa.array([w.tobytes()]), pa.array([v.tobytes()])], names=["w0", "w", "v"])

    sample = (picked.select(F.col("doc_id").cast("long"), "text", "quality")
              .mapInArrow(sparse, "doc_id long, quality int, spots array<int>, values array<float>")
              .orderBy("doc_id", "quality", F.xxhash64("spots", "values")).limit(max_rows))
    got = sample.coalesce(1).mapInArrow(learn, "w0 double, w binary, v binary").first()  # at most max_rows rows in the task
    if got is None:
        return fit([], np.empty(0))
    return got["w0"], np.frombuffer(got["w"]), np.frombuffer(got["v"]).reshape(N_FEATURES, RANK)


def score_documents(docs: DataFrame, machine) -> DataFrame:
    """(doc_id, text_key columns aside) doc_id, held_out and score of every row of ``docs``, by its whole text."""
    w0, w, v = machine
    w, v = w.astype(np.float32), v.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for b in batches:
            scores = np.empty(b.num_rows)
            for i in range(b.num_rows):
                spots, values = features(b.column(1)[i].as_py(), cache)
                xv = v[spots] * values[:, None]
                sums = xv.sum(axis=0)
                scores[i] = w0 + w[spots] @ values + 0.5 * ((sums * sums).sum() - (xv * xv).sum())
            scores = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores)], names=["row", "score"])

    return docs.select("row", "text").mapInArrow(run, f"row {docs.schema['row'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= THRESHOLD) of every row of ``docs``.

    Reads ``doc_id`` and ``text`` of documents and ``doc_id`` and ``quality`` of labels; no other column enters a
    score. Null and empty texts are scored by their (empty) structure. Rows that repeat an id are scored one by
    one, a null id is never held out, an empty table gives an empty result; without labels every score is near 0.5.
    """
    machine = fit_on(docs, labels, max_rows)
    scored = score_documents(docs.select(F.struct("doc_id").alias("row"), "text"), machine)
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches THRESHOLD."""
    machine = fit_on(docs, labels, max_rows)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    return score_documents(packed, machine).where(F.col("score") >= THRESHOLD).select("row.*")
