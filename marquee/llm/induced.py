"""Suffix sorting of one shard by external induction.

Suffixes are sorted from a sparse set: those that start at a local minimum of the text (the character is smaller than
the one before, and what follows is not smaller) are sorted by recursion on a shorter text of names; all others follow
from them by two sweeps. Each sweep takes the smallest (then the largest) suffix from a priority queue of tuples
(position, common prefix with the suffix taken before) and puts the suffix one character to its left back into it.
Ranks only rise during a sweep, so the queue is first in first out within a leading character; entries beyond the
memory budget go to an unlinked scratch file of the task, as do the types and the sorted runs. The given text and the
arrays over the local minima (places, their order, names) stay in memory. Common prefix values travel with the tuples:
two neighbours share one character more than the suffixes they were induced from, which is a range minimum over the
values taken since. Whole runs are handled at once in numpy.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20
BASE_SIZE = 1 << 20   # names up to which a level is sorted in memory instead of by recursion
NO_LIMIT = np.iinfo(np.int32).max


class Scratch:
    """Arrays beyond the memory budget, in one unlinked file."""

    def __init__(self, budget: int):
        self.budget = budget
        self.used = 0
        self.spilled = 0
        self._file = None

    def _open(self):
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        return self._file

    def keep(self, array: np.ndarray):
        """A handle for ``array``: the array itself while there is room, else its place in the file."""
        if self.used + array.nbytes <= self.budget:
            self.used += array.nbytes
            return array
        file = self._open()
        file.seek(0, 2)
        at = file.tell()
        file.write(np.ascontiguousarray(array).data)
        self.spilled += array.nbytes
        return at, len(array), array.dtype

    def take(self, handle) -> np.ndarray:
        if isinstance(handle, np.ndarray):
            self.used -= handle.nbytes
            return handle
        at, length, dtype = handle
        self._file.seek(at)
        return np.frombuffer(self._file.read(length * dtype.itemsize), dtype=dtype)

    def mapped(self, length: int, dtype) -> np.ndarray:
        """A zeroed array: in memory while there is room, else a mapped file."""
        if self.used + length * np.dtype(dtype).itemsize <= self.budget:
            self.used += length * np.dtype(dtype).itemsize
            return np.zeros(length, dtype=dtype)
        with tempfile.TemporaryFile() as file:
            return np.memmap(file, dtype=dtype, mode="w+", shape=(length,))

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
            self._file = None


class BucketQueue:
    """Monotone priority queue of (position, common prefix), first in first out within a leading character.

    Characters lie in groups. What is put in for a group ahead is kept as it comes; when the sweep reaches the
    group, its entries are dealt to their characters, in the order they came.
    """

    def __init__(self, sigma: int, scratch: Scratch):
        self.width = max(1, int(sigma**0.5))
        self.groups: list[list] = [[] for _ in range(sigma // self.width + 1)]
        self.open = -1
        self.runs: dict[int, list] = {}
        self.scratch = scratch

    def push(self, chars: np.ndarray, positions: np.ndarray, prefixes: np.ndarray) -> None:
        """Entries sorted by character."""
        group = chars // self.width
        cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            number = int(group[a])
            if number == self.open:
                self._deal(chars[a:b], positions[a:b], prefixes[a:b])
            else:
                keep = self.scratch.keep
                self.groups[number].append((keep(chars[a:b]), keep(positions[a:b]), keep(prefixes[a:b])))

    def _deal(self, chars: np.ndarray, positions: np.ndarray, prefixes: np.ndarray) -> None:
        cuts = np.append(np.flatnonzero(np.append(True, chars[1:] != chars[:-1])), len(chars)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            self.runs.setdefault(int(chars[a]), []).append((positions[a:b], prefixes[a:b]))

    def pop(self, char: int) -> tuple[np.ndarray, np.ndarray] | None:
        """What has been pushed for ``char`` since it was last taken, in order."""
        if char // self.width != self.open:
            self.open = char // self.width
            parts, self.groups[self.open] = self.groups[self.open], []
            if parts:
                chars, positions, prefixes = (np.concatenate([self.scratch.take(p[i]) for p in parts]) for i in range(3))
                order = np.argsort(chars, kind="stable")
                self._deal(chars[order], positions[order], prefixes[order])
        parts = self.runs.pop(char, None)
        if parts is None or len(parts) == 1:
            return parts and parts[0]
        return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo..hi], ends included, for each pair, from a table of powers of two."""
    span = hi - lo + 1
    widest = int(span.max())
    if widest == 1:
        return values[lo]
    out = np.empty(len(lo), dtype=values.dtype)
    level, table, size = 0, values, 1
    power = np.frexp(span.astype(np.float64))[1] - 1
    order = np.argsort(power.astype(np.int8), kind="stable")
    cuts = np.searchsorted(power[order], np.arange(power.max() + 2))
    while size <= widest:
        at = order[cuts[level]:cuts[level + 1]]
        if len(at):
            out[at] = np.minimum(table[lo[at]], table[hi[at] - size + 1])
        if 2 * size <= widest:
            table = np.minimum(table[:-size], table[size:])
        size, level = 2 * size, level + 1
    return out


def suffix_types(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """1 where a suffix is smaller than the one behind it. The last character must be the only smallest one."""
    n = len(text)
    small = scratch.mapped(n, np.uint8)
    small[n - 1] = 1
    carried = 1
    for end in range(n - 1, 0, -BLOCK):
        begin = max(0, end - BLOCK)
        here, following = text[begin:end], text[begin + 1:end + 1]
        differs = here != following
        # The nearest place to the right, within the block, that differs from its neighbour decides.
        where = np.where(differs, np.arange(end - begin), end - begin)
        nearest = np.minimum.accumulate(where[::-1])[::-1]
        verdict = np.append((here < following).view(np.uint8), np.uint8(carried))
        small[begin:end] = verdict[nearest]
        carried = int(small[begin])
    return small


def local_minima(small: np.ndarray) -> np.ndarray:
    """Positions of the sparse suffixes, in text order."""
    parts = []
    for begin in range(1, len(small), BLOCK):
        end = min(len(small), begin + BLOCK)
        parts.append(begin + np.flatnonzero(small[begin:end] > small[begin - 1:end - 1]))
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def _run_length(text: np.ndarray, at: int, limit: int) -> int:
    part = np.asarray(text[at:at + limit])
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


class _Sweep:
    """One sweep over the buckets: takes blocks of suffixes and queues the suffixes to their left."""

    def __init__(self, text, small, wanted: int, sigma: int, scratch: Scratch, limit: int, prefixes: bool):
        self.text, self.small, self.wanted, self.limit, self.prefixes = text, small, wanted, limit, prefixes
        self.queue = BucketQueue(sigma, scratch)
        self.low = np.full(sigma, NO_LIMIT, dtype=np.int32)   # least value since the last push of a character
        self.fresh = np.ones(sigma, dtype=bool)

    def take(self, positions: np.ndarray, values: np.ndarray) -> None:
        for at in range(0, len(positions), BLOCK):
            self._take(positions[at:at + BLOCK], values[at:at + BLOCK])

    def _take(self, positions: np.ndarray, values: np.ndarray) -> None:
        left = positions - 1
        ok = left >= 0
        ok[ok] = self.small[left[ok]] == self.wanted
        source = np.flatnonzero(ok)
        if self.prefixes:
            least = int(values.min())
        if not len(source):
            if self.prefixes:
                np.minimum(self.low, least, out=self.low)
            return
        left = left[source]
        chars = np.asarray(self.text[left])
        order = np.argsort(chars, kind="stable")
        chars, left, source = chars[order], left[order], source[order]
        heads = np.flatnonzero(np.append(True, chars[1:] != chars[:-1]))
        if self.prefixes:
            lo = np.empty(len(source), dtype=np.int64)
            lo[1:] = source[:-1] + 1
            lo[heads] = 0
            got = _range_min(values, lo, source)
            first = chars[heads]
            got[heads] = np.minimum(got[heads], self.low[first])
            got = np.minimum(got, self.limit - 1).astype(np.int32) + 1
            got[heads[self.fresh[first]]] = 0
            np.minimum(self.low, least, out=self.low)
            ends = np.append(heads[1:], len(source)) - 1
            last = source[ends]
            tail = np.full(len(last), NO_LIMIT, dtype=np.int32)
            some = last + 1 < len(values)
            if some.any():
                rest = np.minimum.accumulate(values[::-1])[::-1]
                tail[some] = rest[last[some] + 1]
            self.low[first] = tail
            self.fresh[first] = False
        else:
            got = np.zeros(len(source), dtype=np.int32)
        self.queue.push(chars, left, got)


def induce(text: np.ndarray, small: np.ndarray, sigma: int, seeds: np.ndarray, seed_prefixes: np.ndarray | None,
           scratch: Scratch, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes but the last one, largest first, as blocks (positions, common prefix with the one given before).

    ``seeds`` are the sparse suffixes in order, ``seed_prefixes`` what each shares with the one before it (None: no
    prefix values are carried). Values are cut at ``limit``.
    """
    carry = seed_prefixes is not None
    first = np.asarray(text[seeds])
    cuts = np.searchsorted(first, np.arange(sigma + 1))
    rising = _Sweep(text, small, 0, sigma, scratch, limit, carry)
    runs: list[list] = [[] for _ in range(sigma)]
    for char in range(sigma):
        last = -1
        while (got := rising.queue.pop(char)) is not None:
            positions, values = got
            last = int(positions[-1])
            rising.take(positions, values)
            runs[char].append((scratch.keep(positions), scratch.keep(values)))
        a, b = int(cuts[char]), int(cuts[char + 1])
        if b > a:
            if carry:
                values = seed_prefixes[a:b].copy()
                values[0] = 0 if last < 0 else min(_run_length(text, last, limit), _run_length(text, int(seeds[a]), limit))
            else:
                values = np.zeros(b - a, dtype=np.int32)
            rising.take(seeds[a:b], values)
    falling = _Sweep(text, small, 1, sigma, scratch, limit, carry)
    for char in range(sigma - 1, -1, -1):
        last = -1
        while (got := falling.queue.pop(char)) is not None:
            last = int(got[0][-1])
            falling.take(*got)
            yield got
        if runs[char]:
            parts = [(scratch.take(p), scratch.take(v)) for p, v in runs[char]]
            runs[char] = []
            positions = np.concatenate([p for p, _ in parts])[::-1]
            values = np.concatenate([v for _, v in parts])
            values = np.append(np.int32(0), values[:0:-1]).astype(np.int32)
            if carry and last >= 0:
                values[0] = min(_run_length(text, last, limit), _run_length(text, int(positions[0]), limit))
            falling.take(positions, values)
            yield positions, values


def _names(text: np.ndarray, places: np.ndarray, ordered: np.ndarray, n: int) -> np.ndarray:
    """Name (from 0, in order) of the piece at each place; pieces run to the next place, that character included."""
    length = np.append(np.diff(places) + 1, 1)
    size = np.zeros(len(places), dtype=np.int64)
    index = np.searchsorted(places, ordered)
    size = length[index]
    same = np.append(False, size[1:] == size[:-1])
    active = np.flatnonzero(same)
    step = 0
    while len(active):
        a, b = ordered[active - 1] + step, ordered[active] + step
        equal = np.asarray(text[a]) == np.asarray(text[b])
        same[active[~equal]] = False
        step += 1
        active = active[equal]
        active = active[size[active] > step]
    names = np.empty(len(places), dtype=np.int64)
    names[index] = np.cumsum(~same) - 1
    return names


def _by_doubling(names: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of a short text up to ``depth`` names, and their common prefixes."""
    rank, levels, width, n = names.astype(np.int64), [], 1, len(names)
    while True:
        levels.append(rank.astype(np.int32) if n < NO_LIMIT else rank)
        if width >= depth or rank.max() == n - 1:
            break
        behind = np.zeros(n, dtype=np.int64)
        behind[:max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + behind
        _, rank = np.unique(key, return_inverse=True)
        width *= 2
    order = np.argsort(rank, kind="stable")
    shared = np.zeros(n, dtype=np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    total = np.zeros(n - 1, dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ok = (a < n) & (b < n)
        ok[ok] = levels[k][a[ok]] == levels[k][b[ok]]
        total[ok] += 1 << k
        a[ok] += 1 << k
        b[ok] += 1 << k
    shared[1:] = total
    return order, shared


def _sorted_minima(text: np.ndarray, small: np.ndarray, sigma: int, scratch: Scratch, limit: int,
                   base_size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sparse suffixes in order, and what each shares with the one before, by recursion on their names."""
    places = local_minima(small)
    if len(places) < 2:
        return places, np.zeros(len(places), dtype=np.int32)
    start = places[np.argsort(np.asarray(text[places]), kind="stable")]
    parts = [p[(small[p] > small[np.maximum(p, 1) - 1]) & (p > 0)] for p, _ in induce(text, small, sigma, start, None, scratch, limit)]
    ordered = np.concatenate([places[-1:], *[p[::-1] for p in reversed(parts)]])  # the last place is the smallest
    names = _names(text, places, ordered, len(text))
    distinct = int(names.max()) + 1
    if distinct == len(places):
        order, shared = np.argsort(names), np.zeros(len(places), dtype=np.int64)
    else:
        # Names as digits, so that every level has a small alphabet; the text of digits ends with its own smallest.
        digits = 2 if distinct <= 1 << 22 else 3
        base = int(np.ceil(distinct ** (1 / digits))) + 1
        if len(places) <= base_size or digits * len(places) > 0.95 * len(text):
            order, shared = _by_doubling(names, limit)
        else:
            shorter = scratch.mapped(digits * len(places) + 1, np.uint16)
            rest = names
            for d in range(digits - 1, -1, -1):
                shorter[d:-1:digits] = rest % base + 1
                rest = rest // base
            at, common = suffix_order(shorter, base + 2, scratch, min(limit * digits, len(shorter)), base_size)
            whole = np.flatnonzero((at % digits == 0) & (at < len(shorter) - 1))
            order = at[whole] // digits
            shared = np.minimum.reduceat(common, np.append(0, whole[:-1] + 1)) // digits if len(whole) else common[:0]
    seeds = places[order]
    # Whole shared names give the common prefix up to the names that differ; the rest is compared.
    prefixes = np.zeros(len(seeds), dtype=np.int64)
    if len(seeds) > 1:
        step = np.minimum(shared[1:], len(places) - 1 - np.maximum(order[1:], order[:-1]))
        prefixes[1:] = np.minimum(places[order[1:] + step] - seeds[1:], limit)
        active = np.flatnonzero(prefixes < limit)
        active = active[active > 0]
        while len(active):
            a, b = seeds[active - 1] + prefixes[active], seeds[active] + prefixes[active]
            ok = np.maximum(a, b) < len(text)
            active, a, b = active[ok], a[ok], b[ok]
            active = active[np.asarray(text[a]) == np.asarray(text[b])]
            prefixes[active] += 1
            active = active[prefixes[active] < limit]
    return seeds, prefixes.astype(np.int32)


def suffixes_down(text: np.ndarray, sigma: int, scratch: Scratch, limit: int,
                  base_size: int = BASE_SIZE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of ``text`` but the last, largest first, with the prefix each shares with the one given before.

    The last character must be 0 and the only 0. The order is exact up to ``limit`` characters.
    """
    small = suffix_types(text, scratch)
    seeds, prefixes = _sorted_minima(text, small, sigma, scratch, limit, base_size)
    yield from induce(text, small, sigma, seeds, prefixes, scratch, limit)


def suffix_order(text: np.ndarray, sigma: int, scratch: Scratch, limit: int, base_size: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and what each shares with the one before."""
    blocks = list(suffixes_down(text, sigma, scratch, limit, base_size))
    down = np.concatenate([p for p, _ in blocks])
    shared = np.concatenate([v for _, v in blocks])
    order = np.append(len(text) - 1, down[::-1])
    common = np.zeros(len(order), dtype=np.int64)
    common[2:] = shared[1:][::-1]  # downwards, a value belongs to the pair with the larger suffix, given before
    return order, common


def repeated_starts(text: np.ndarray, sigma: int, length: int, budget: int = 256 << 20,
                    base_size: int = BASE_SIZE) -> np.ndarray:
    """1 at each position of ``text`` whose next ``length`` characters also start elsewhere in it."""
    scratch = Scratch(budget)
    flags = scratch.mapped(len(text), np.uint8)
    before = -1
    try:
        for positions, shared in suffixes_down(text, sigma, scratch, length, base_size):
            hit = np.flatnonzero(shared >= length)
            flags[positions[hit]] = 1
            flags[np.where(hit > 0, positions[hit - 1], before)] = 1
            before = int(positions[-1])
    finally:
        scratch.close()
    return flags
