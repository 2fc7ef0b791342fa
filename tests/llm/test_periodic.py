import hashlib
import random
import zlib

import numpy as np
import pytest

from marquee.llm import periodic, registry
from conftest_llm import FOLDER, documents


def by_hand(x):
    """All maximal runs, period by period; a period that is a multiple of a smaller one of the same run is none."""
    n, out = len(x), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            length = i + q - start
            part = x[start:start + length]
            if length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(count, seed=1):
    rng = random.Random(seed)
    for _ in range(count):
        n = rng.randrange(0, 90)
        x = [rng.randrange(rng.randrange(1, 5)) for _ in range(n)]
        if n > 8 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + (n - a) // (3 + rng.randrange(8))
            x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
        yield x


def test_extensions_on_the_grammar():
    rng = random.Random(2)
    for x in sequences(400):
        n, grammar = len(x), periodic.Grammar(np.array(x, dtype=np.int64))
        for _ in range(8 if n > 1 else 0):
            i, j = sorted(rng.sample(range(n), 2))
            ahead = next((k for k in range(n - j) if x[i + k] != x[j + k]), n - j)
            back = next((k for k in range(i) if x[i - 1 - k] != x[j - 1 - k]), i)
            assert (grammar.extension(i, j), grammar.extension_back(i, j)) == (ahead, back)


def test_runs_equal_all_periods(monkeypatch):
    cases = list(sequences(800))
    assert all(periodic.runs_of(np.array(x, dtype=np.int32)) == by_hand(x) for x in cases)
    monkeypatch.setattr(periodic, "GRID_WORDS", 10)  # period by period, the way of very long texts
    assert all(periodic.runs_of(np.array(x, dtype=np.int32)) == by_hand(x) for x in cases[:300])


def test_long_and_degenerate_texts():
    assert periodic.runs_of(np.zeros(50_000, dtype=np.int32)) == [(0, 50_000, 1)]
    assert periodic.runs_of(np.tile(np.arange(211, dtype=np.int32), 200)) == [(0, 42_200, 211)]
    assert periodic.runs_of(np.arange(40_000, dtype=np.int32)) == []


def test_strongest_is_exact_and_first_of_equals():
    assert periodic.strongest([]) is None
    assert periodic.strongest([(0, 8, 2), (20, 13, 3), (40, 26, 6), (70, 13, 3)]) == (20, 13, 3)


def planted(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digest(doc_id, text):
    words = planted(doc_id, text)
    runs = by_hand(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, e, q in runs for i in range(s + q, s + e)}
    sha = [hashlib.sha256(b).hexdigest() for b in (
        "".join(f"{s},{e},{q}\n" for s, e, q in runs).encode(), b" ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_hand_count_on_given_documents(spark, given):
    short = {r["doc_id"]: r["text"] for r in given.collect() if len((r["text"] or "").split()) < 700}
    got = {r["doc_id"]: tuple(r) for r in registry.op13_periodic_runs(spark, FOLDER).select(*COLUMNS).collect()}
    assert len(got) == given.count()
    assert all(got[i] == digest(i, text) for i, text in short.items())
    assert any(row[1] for row in got.values())


@pytest.fixture(scope="module")
def corner(spark, odd):
    tail = "stop " * 9 + "a b c a b c a b c a b c a x " + "é è " * 6
    return odd.unionByName(documents(spark, [(500, tail), (501, tail * 3), (501, tail * 3), (502, "x\x0bx\x0cx\tx\nx\rx  x")]))


def test_odd_rows_and_planted_ones(spark, corner):
    found = registry_rows(periodic.periodic_runs(periodic.with_planted_runs(corner)))
    want = sorted(((r["doc_id"], len(planted(r["doc_id"], r["text"])), by_hand(planted(r["doc_id"], r["text"])))
                   for r in corner.collect() if len((r["text"] or "").split()) < 3000), key=str)
    long = {9}  # brute force over its 18,000 words takes too long
    assert [f for f in found if f[0] not in long] == [w for w in want if w[0] not in long]


def registry_rows(df):
    return sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]]) for r in df.collect()), key=str)


def test_no_rows(none):
    assert periodic.periodic_runs(periodic.with_planted_runs(none)).collect() == []
