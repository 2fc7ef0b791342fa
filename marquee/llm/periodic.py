"""Periodic runs of words by recompression.

The words of a text become numbers, and rounds of block compression (a repeated symbol becomes one symbol) and pair
compression (neighbours from two halves of the alphabet become one symbol) shrink them to a single symbol. The rounds
are a run-length grammar of the text: equal stretches are cut alike but for their ends, so a longest common extension
climbs the rounds while both places start a symbol and descends again at the first difference. A run of at least four
periods q covers four neighbouring multiples of q; places on this harmonic grid whose words agree are candidates, and
two extensions on the grammar, one ahead and one back, give the exact run. A text is worked on where it lies; the
tables of a text grow with its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import SPACE_CLASS, let

MIN_WORDS = 6        # shortest run
MIN_EXPONENT = 4     # fewest periods of a run; the grid needs this many neighbouring places
GRID_WORDS = 32768   # texts up to this many words share one table of grid places


def _side(symbols: np.ndarray, round_: int) -> np.ndarray:
    """The half of the alphabet a symbol belongs to in a round: a bit of a mixed hash."""
    x = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(round_ * 0x632BE59BD9B4E019 % 2**64)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) & np.uint64(1)


class Grammar:
    """Rounds of compression of one sequence of numbers, and the common extensions they answer.

    ``symbols[k]`` is the sequence after k rounds, ``heads[k]`` the places where its groups start (with the length
    at the end), ``parents[k]`` the group of each place, ``blocks[k]`` whether the groups are repeated symbols.
    """

    def __init__(self, sequence: np.ndarray):
        now = np.asarray(sequence, dtype=np.int64)
        fresh = int(now.max()) + 1 if len(now) else 0
        self.length = len(now)
        self.symbols, self.heads, self.parents, self.blocks = [now.tolist()], [], [], []
        round_ = 0
        while len(now) > 1:
            block = round_ % 2 == 0
            if block:
                opens = np.concatenate([[True], now[1:] != now[:-1]])
            else:
                side = _side(now, round_)
                opens = np.concatenate([[True], ~((side[:-1] == 0) & (side[1:] == 1))])
            round_ += 1
            heads = np.flatnonzero(opens)
            if len(heads) == len(now):
                continue
            sizes = np.diff(heads, append=len(now))
            after, grouped = now[heads], np.flatnonzero(sizes > 1)
            second = sizes[grouped] if block else now[heads[grouped] + 1]
            # Symbols and lengths stay below a few times the length of the text, so that a pair fits one number.
            names, which = np.unique(after[grouped] * (1 << 31) + second, return_inverse=True)
            after[grouped] = fresh + which
            fresh += len(names)
            self.heads.append([*heads.tolist(), len(now)])
            self.parents.append((np.cumsum(opens) - 1).tolist())
            self.blocks.append(block)
            now = after
            self.symbols.append(now.tolist())

    def extension(self, i: int, j: int) -> int:
        """How many numbers from place ``i`` on equal those from place ``j`` on, for i < j."""
        level, a, b = 0, i, j
        climbing = True
        while True:
            row = self.symbols[level]
            while b < len(row) and row[a] == row[b]:
                heads, parents = self.heads[level], self.parents[level]
                over_a, over_b = parents[a], parents[b]
                if climbing and heads[over_a] == a and heads[over_b] == b:
                    level, a, b = level + 1, over_a, over_b
                    row = self.symbols[level]
                    continue
                # Two blocks of one symbol agree along the shorter rest.
                step = min(heads[over_a + 1] - a, heads[over_b + 1] - b) if self.blocks[level] else 1
                a, b = a + step, b + step
            if b >= len(row):
                return self.length - j
            if not level:
                return a - i
            climbing = False
            level -= 1
            a, b = self.heads[level][a], self.heads[level][b]

    def extension_back(self, i: int, j: int) -> int:
        """How many numbers before place ``i`` equal those before place ``j``, for i < j."""
        level, a, b = 0, i, j
        climbing = True
        while True:
            row = self.symbols[level]
            while a and row[a - 1] == row[b - 1]:
                heads, parents = self.heads[level], self.parents[level]
                over_a, over_b = parents[a - 1], parents[b - 1]
                if climbing and heads[over_a + 1] == a and heads[over_b + 1] == b:
                    level, a, b = level + 1, over_a + 1, over_b + 1
                    row = self.symbols[level]
                    continue
                step = min(a - heads[over_a], b - heads[over_b]) if self.blocks[level] else 1
                a, b = a - step, b - step
            if not a:
                return i
            if not level:
                return i - a
            climbing = False
            level -= 1
            a, b = self.heads[level][a], self.heads[level][b]


def _grid(words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grid places (place, period) of all texts up to ``words`` words, ordered by the last word they look at."""
    places = [np.arange(0, words - (MIN_EXPONENT - 1) * q, q) for q in range(1, words // MIN_EXPONENT + 1)]
    periods = np.repeat(np.arange(1, len(places) + 1), [len(p) for p in places])
    place = np.concatenate(places) if places else np.empty(0, np.int64)
    last = place + (MIN_EXPONENT - 1) * periods
    order = np.argsort(last, kind="stable")
    return place[order].astype(np.int32), periods[order].astype(np.int32), last[order]


_PLACE, _PERIOD, _LAST = _grid(GRID_WORDS)
_NEXT = _PLACE + _PERIOD


def candidates(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) on the harmonic grid where MIN_EXPONENT places in a row hold the same word, by period."""
    n = len(x)
    if n <= GRID_WORDS:
        upto = int(np.searchsorted(_LAST, n))
        same = np.flatnonzero(x[_PLACE[:upto]] == x[_NEXT[:upto]])
        place, period = _PLACE[same], _PERIOD[same]
        for k in range(2, MIN_EXPONENT):
            same = np.flatnonzero(x[place] == x[place + k * period])
            place, period = place[same], period[same]
        order = np.lexsort((place, period))
        return place[order], period[order]
    found = []
    for q in range(1, n // MIN_EXPONENT + 1):
        on = x[::q]
        width = len(on) - MIN_EXPONENT + 1
        same = on[:width] == on[1:1 + width]
        for k in range(2, MIN_EXPONENT):
            same &= on[:width] == on[k:k + width]
        hit = np.flatnonzero(same)
        if len(hit):
            found.append((hit * q, np.full(len(hit), q)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run with its smallest period and enough periods, by start and period."""
    n = len(x)
    place, period = candidates(x)
    if not len(place):
        return []
    grammar = Grammar(x)
    # How far the runs of smaller periods that hold a place reach: what lies in them has a smaller period.
    reach = np.zeros(n, dtype=np.int64)
    span = MIN_EXPONENT - 1
    edges = [*(np.flatnonzero(np.diff(period, prepend=0)).tolist()), len(period)]
    runs = []
    for lo, hi in zip(edges, edges[1:]):
        q, here = int(period[lo]), place[lo:hi]
        for i in here[reach[here] <= here + span * q].tolist():
            if reach[i] > i + span * q:
                continue
            start = i - grammar.extension_back(i, i + q)
            end = i + q + grammar.extension(i, i + q)
            if end - start >= max(MIN_WORDS, MIN_EXPONENT * q) and reach[start] < end:
                runs.append((start, end - start, q))
                reach[start:end] = np.maximum(reach[start:end], end)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods, compared exactly; of equal ones that which starts first, then of the smaller period."""
    best = None
    for run in runs:  # in order of start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = ("n_words long, runs array<struct<start:long,length:long,period:long>>, "
         "strongest struct<start:long,length:long,period:long>, collapsed string")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, runs_out, best_out, texts = [], [], [], []
        for text in batch.column(1):
            words = (text.as_py() or "").encode("utf-8").split()
            number = {w: k for k, w in enumerate(dict.fromkeys(words))}
            x = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
            # A run needs a word that stands as often as it has periods.
            runs = runs_of(x) if len(words) - len(number) >= MIN_EXPONENT - 1 else []
            best = strongest(runs)
            keep = np.ones(len(words), dtype=bool)
            for start, length, q in runs:
                keep[start + q:start + length] = False
            counts.append(len(words))
            runs_out.append([{"start": s, "length": e, "period": q} for s, e, q in runs])
            best_out.append(dict(zip(("start", "length", "period"), best)) if best else None)
            texts.append(b" ".join(w for w, k in zip(words, keep.tolist()) if k) if runs else b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs_out, pa.list_(_RUN)), pa.array(best_out, _RUN),
             pa.array(texts, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "strongest", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period), strongest (one of them or null)
    and collapsed, the text without the words that only repeat a run's first period, joined by single spaces.

    Reads ``doc_id`` and ``text``; other columns are ignored. Words are what white space separates and are compared
    as they are. Null, empty and blank texts have no words, no runs and an empty collapsed text; null ids stay null;
    rows that repeat an id or a text are worked on one by one; an empty table gives an empty result. Runs of equal
    strength: the first by start, then by period, is the strongest.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_find, f"doc_id {kind}, {FOUND}")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where a tenth of the texts, chosen by the checksum of the id, repeat from a word on.

    h is the CRC-32 of the decimal id and g = h div 10. If h mod 10 is 0, each word i >= a = g mod n becomes word
    a + (i - a) mod p of the text, p = 1 + (n - a) div (3 + g mod 8). Rows with a null id, or without words, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        moved = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p)))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    words = F.filter(F.split("text", SPACE_CLASS + "+"), lambda w: w != "")
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), let(words, repeated))
                       .otherwise(F.col("text")).alias("text"))
