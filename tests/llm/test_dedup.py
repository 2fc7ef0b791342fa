"""Exact, line, substring and SimHash deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest_llm import documents, prose

from marquee.llm import exact_dedup, line_dedup, simhash, suffix_dedup
from marquee.llm.induced import Scratch, repeated_starts, suffix_order


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ---- exact dedup

def test_cuckoo_index_against_a_dict():
    rng, index, truth = random.Random(1), exact_dedup.CuckooIndex(2), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for _ in range(20_000):
        k = rng.choice(keys)
        if rng.random() < 0.3:
            assert index.delete(k) == (truth.pop(k, None) is not None)
        elif rng.random() < 0.5:
            index.set(k, (1,))
            truth[k] = (1,)
        else:
            assert index.find(k) == truth.get(k)
    assert index.resizes > 0 and index.keys == truth


def exact_brute(rows):
    groups = {}
    for place, (i, t) in enumerate(rows):
        text = t or ""
        norm = re.sub(r"[\x20\x09-\x0D]", "", text)
        groups.setdefault(norm, []).append((-len(text), i is None, i or 0, place))
    out = []
    for norm, members in groups.items():
        first = min(members)  # one row stays, also where rows repeat its id
        keep = rows[first[3]][0]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(rows[m[3]][0], keep, len(members), m == first, digest) for m in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("table", ["odd", "given", "none"])
def test_exact_dedup(table, request):
    docs = request.getfixturevalue(table)
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs).collect()), key=str)
    assert got == exact_brute(pairs(docs))


def test_one_row_of_a_repeated_id_stays(spark):
    docs = documents(spark, [(1, "a b"), (1, "a b"), (1, "a  b"), (2, "ab"), (2, "c"), (2, "c")])
    for n in (1, 3, 7):
        got = exact_dedup.exact_dedup(docs.repartition(n)).collect()
        kept = sorted((r["doc_id"], r["group_size"]) for r in got if r["kept"])
        assert kept == [(1, 4), (2, 2)] and {r["keep_id"] for r in got} == {1, 2}


def test_maintained_index(spark):
    docs = lambda *t: documents(spark, [(i, x) for i, x in enumerate(t)])
    empty = spark.createDataFrame([], "digest binary, n_docs long")
    first = exact_dedup.maintain(empty, docs("a", "a ", "b", None), docs())
    second = exact_dedup.maintain(first, docs("c"), docs("a", "b", "never there", "c", "c"))
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    assert {bytes(r["digest"]): r["n_docs"] for r in first.collect()} == {digest("a"): 2, digest("b"): 1, digest(""): 1}
    assert {bytes(r["digest"]): r["n_docs"] for r in second.collect()} == {digest("a"): 1, digest(""): 1}


# ---- line dedup

def lines_brute(rows, run=3, long=200):
    ordered = sorted({(i is None, i or 0, i, t) for i, t in rows if t is not None}, key=lambda x: (x[0], x[1], x[3]))
    first, result = {}, {}
    for *_, i, t in ordered:
        lines, gone = t.split("\n"), set()
        for n in range(1, run + 1):
            for at in range(len(lines) - n + 1):
                if n < run and sum(map(len, lines[at:at + n])) < long:
                    continue
                where = first.setdefault(tuple(lines[at:at + n]), (i, t, at))
                if where[:2] != (i, t) or where[2] + n <= at:
                    gone |= set(range(at, at + n))
        result[i, t] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone),
                        sum(k - 1 not in gone for k in gone))
    return sorted([(i, *result.get((i, t), (None, 0, 0, 0))) for i, t in rows], key=str)


@pytest.mark.parametrize("table", ["odd", "given", "none"])
def test_line_dedup(table, request):
    docs = request.getfixturevalue(table)
    got = sorted((tuple(r) for r in line_dedup.dedup_lines(docs).collect()), key=str)
    assert got == lines_brute(pairs(docs))


def test_later_run_goes_and_first_stays(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "a\nb\ny")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert got == {1: "a\nb\nc\nd", 2: "x\ny", 3: "a\nb\ny"}


def test_one_long_line_goes_where_it_stands_again(spark):
    long = prose(random.Random(8), 60)
    assert len(long) >= line_dedup.LONG
    rows = [(1, long), (2, long), (3, f"head\n{long}\ntail"), (4, f"{long}\nshort"), (5, f"x\n{long}\nshort"), (6, "head\ntail")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert got == {1: long, 2: "", 3: "head\ntail", 4: "short", 5: "x", 6: "head\ntail"}


def test_line_matches_of_every_length(spark):
    """Passages of 1 to 9 lines from a small stock, at random places: equal to all runs compared with all."""
    rng = random.Random(12)
    stock = [[rng.choice(["", "a", "b", "c" * 90, "d" * 150, "e" * 201, str(rng.randrange(20))]) for _ in range(9)] for _ in range(12)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            s, a = rng.choice(stock), rng.randrange(9)
            lines += [str(rng.random()) for _ in range(rng.randrange(3))] + s[a:a + rng.randrange(1, 9)]
        rows.append((i if i else None, "\n".join(lines)))
    rows += rng.sample(rows, 5)  # repeated rows are one document
    for run, gram in ((3, 2), (5, 3), (2, 1)):
        got = line_dedup.dedup_lines(documents(spark, rows).repartition(3), run, gram).collect()
        assert sorted(map(tuple, got), key=str) == lines_brute(rows, run)


# ---- substring dedup

def brute_starts(symbols, length):
    seen = defaultdict(list)
    for i in range(len(symbols) - length + 1):
        seen[tuple(symbols[i:i + length])].append(i)
    flags = np.zeros(len(symbols), np.uint8)
    for at in seen.values():
        if len(at) > 1:
            flags[at] = 1
    return flags


def test_induced_sorting_small_texts():
    rng = random.Random(5)
    for _ in range(60):
        n, k = rng.choice([2, 5, 30, 200]), rng.choice([1, 2, 3, 40])
        t = [rng.randrange(1, k + 1) for _ in range(n)]
        at, cut = rng.randrange(n), rng.randrange(n)
        t[at:at] = t[cut:] + [1] * rng.randrange(9)
        text = np.array([*t, 0], dtype=np.uint16)
        # Recursion down to nothing, a tiny base, and everything spilled.
        for base, budget in ((0, 1 << 20), (5, 1000), (1 << 20, 0)):
            length = rng.choice([1, 2, 5, 20])
            assert (repeated_starts(text, k + 2, length, budget, base) == brute_starts([int(x) for x in text], length)).all()
        order, shared = suffix_order(text, k + 2, Scratch(1 << 20), 10**6, 0)
        suffixes = [tuple(int(x) for x in text[i:]) for i in order]
        assert suffixes == sorted(suffixes)
        for a, b, s in zip(suffixes, suffixes[1:], shared[1:]):
            assert a[:s] == b[:s] and (len(a) == s or len(b) == s or a[s] != b[s])


def test_spilled_sort_is_the_same():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 5, 30_000)
    text = np.append(np.concatenate([text, text[5000:15_000]]), 0).astype(np.uint16)
    scratch = Scratch(20_000)
    order, _ = suffix_order(text, 6, scratch, 10**5, 500)
    assert scratch.spilled > 0
    assert (order == suffix_order(text, 6, Scratch(1 << 28), 10**5, 10**6)[0]).all()


def substring_brute(rows, match):
    raws = [(t or "").encode() for _, t in rows]
    count = Counter(r[i:i + match] for r in raws for i in range(len(r) - match + 1))
    out = []
    for (i, _), r in zip(rows, raws):
        gone = np.zeros(len(r) + 2, dtype=int)
        for at in range(len(r) - match + 1):
            if count[r[at:at + match]] > 1:
                gone[at + 1] += 1
                gone[at + match + 1] -= 1
        gone = np.cumsum(gone)[1:len(r) + 1] > 0 if len(r) else np.zeros(0, bool)
        spans = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int)))
        out.append((i, len(r), [tuple(x) for x in spans.reshape(-1, 2).tolist()],
                    bytes(np.frombuffer(r, np.uint8)[~gone])))
    return sorted(out, key=str)


@pytest.mark.parametrize("table,match,anchor,chunk", [
    ("odd", 400, 64, 1 << 21), ("odd", 40, 8, 997), ("odd", 20, 16, 1 << 21), ("given", 100, 32, 5000), ("none", 400, 64, 1 << 21)])
def test_substring_dedup(table, match, anchor, chunk, request):
    docs = request.getfixturevalue(table)
    got = [(r["doc_id"], r["n_bytes"], [(s["a"], s["b"]) for s in r["spans"]], bytes(r["kept"]))
           for r in suffix_dedup.dedup_substrings(docs, match, anchor, chunk).collect()]
    assert sorted(got, key=str) == substring_brute(pairs(docs), match)


# ---- SimHash

def fingerprint_brute(text, shingle):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def components_brute(rows, fps, bits):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[find(k)].append(i)
    return [min((i for i in ids[find(k)] if i is not None), default=None) for k in range(len(rows))]


@pytest.mark.parametrize("table,bits", [("odd", 2), ("given", 2), ("odd", 3), ("none", 2)])
def test_simhash(table, bits, request):
    docs = request.getfixturevalue(table)
    rows = pairs(docs)
    fps = [fingerprint_brute(t, 3) for _, t in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, components_brute(rows, fps, bits))), key=str)
    got = simhash.simhash_components(docs, 3, bits).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_pivot_links_connect_what_is_near():
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 2**63, 3, dtype=np.uint64)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for c in centre]))
    links = simhash.pivot_links(fps, 2, rng.integers(0, 2**64, 24, dtype=np.uint64))
    assert all(int(fps[a] ^ fps[b]).bit_count() <= 2 for a, b in links) and len(links) < len(fps)
    parts = components_brute([(i, None) for i in range(len(fps))], [int(f) for f in fps], 2)
    root = list(range(len(fps)))
    for a, b in links:
        ra, rb = root[a], root[b]
        root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    assert root == parts


def test_keep_first_leaves_one_row_of_each_group(spark):
    rng = random.Random(8)
    text = prose(rng, 200)
    rows = [(5, text), (3, text), (3, text), (9, prose(rng, 200)), (None, text), (None, None), (7, "")]
    kept = simhash.keep_first(documents(spark, rows))
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 7, 9]
    assert kept.columns == documents(spark, rows).columns
