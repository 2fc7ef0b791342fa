"""Mixing, quality, sharding, decontamination, license scans, passages and the pipeline."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest_llm import FOLDER, documents, odd_rows, prose

import corpus_pipeline
from marquee.llm import decontam, licenses, mixing, passages, quality, sharding, simhash
from marquee.llm.oracle import SOURCE_SIZES
from marquee.llm.registry import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lowered(text))


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ---- mixing

def reshared(sizes, weights, budget, ceiling):
    """The rule as it is told: share, cut what is above, share the excess again."""
    targets, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes)], budget
    while open_:
        total = sum(weights[i] for i in open_)
        shares = {i: left * weights[i] / total for i in open_}
        above = [i for i in open_ if shares[i] > ceiling * sizes[i]]
        if not above:
            for i in open_:
                targets[i] = shares[i]
            break
        for i in above:
            targets[i] = ceiling * sizes[i]
            left -= targets[i]
        open_ = [i for i in open_ if i not in above]
    return targets


def test_targets():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 9)
        sizes = [rng.randrange(0, 100) for _ in range(n)]
        weights = [float((5, 2, 1)[i % 3]) for i in range(n)]
        got = mixing.share_targets(sizes, weights, 1.5 * sum(sizes), 2.0)
        assert np.allclose(got, reshared(sizes, weights, 1.5 * sum(sizes), 2.0))
        assert np.isclose(sum(got), 1.5 * sum(sizes))


def test_flow_is_maximal_and_cheapest():
    rng = random.Random(3)
    for _ in range(25):
        sizes = [rng.randrange(1, 4) for _ in range(2)]
        members = [["a"], ["a", "b"]]
        targets = {"a": rng.randrange(0, 6), "b": rng.randrange(0, 6)}
        flows = mixing.route(list(zip(members, sizes)), targets, 2)
        arcs = [(p, r, s) for p in range(2) for r in range(2) for s in members[p]]
        best = None
        for amounts in itertools.product(*[range(sizes[p] + 1) for p, _, _ in arcs]):
            per = Counter()
            for (p, r, s), f in zip(arcs, amounts):
                per[p, r] += f
                per[s] += f
            if all(per[p, r] <= sizes[p] for p in range(2) for r in range(2)) and all(per[s] <= targets[s] for s in targets):
                key = (-sum(amounts), sum(r * r * f for (_, r, _), f in zip(arcs, amounts)))
                best = key if best is None else min(best, key)
        assert (-sum(f for *_, f in flows), sum(r * r * f for _, r, _, f in flows)) == best


def test_mix_fills_targets(spark, given):
    copies = lambda df: {r["doc_id"]: r["copies"] for r in mixing.mix_sources(df).collect()}
    assert copies(given.repartition(7)) == copies(given)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.005 * t for s, t in target.items())


def test_sizes_and_targets_against_sql(given):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    rows = con.execute(SOURCE_SIZES).fetchall()
    got = {r["source"]: (r["source_size"], r["target"]) for r in mixing.mix_sources(given).collect()}
    want = reshared([z for _, z in rows], [float((5, 2, 1)[i % 3]) for i in range(len(rows))], 1.5 * sum(z for _, z in rows), 2.0)
    assert {s: z for s, (z, _) in got.items()} == dict(rows)
    assert np.allclose([got[s][1] for s, _ in rows], want)


def test_mix_of_overlapping_sources(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(1, 20), rng.choice([["a"], ["a", "b"], ["b", "c"], [None], ["c", None]])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>")
    total = sum(r[1] for r in rows)
    targets = {"a": 0.4 * total, "b": 0.5 * total, "c": 0.1 * total, None: 0.2 * total}
    got = mixing.mix(df, targets).collect()
    served, allowed = Counter(), {r[0]: set(r[2]) for r in rows}
    for r in got:
        assert r["copies"] == len(r["served"]) <= 2 and set(r["served"]) <= allowed[r["doc_id"]]
        for s in r["served"]:
            served[s] += r["size"]
    assert all(abs(served[s] - t) < 0.01 * t + 20 for s, t in targets.items())


def test_mix_of_repeated_ids_is_the_same_in_any_partitioning(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(50), " ".join(rng.choices("abcdefgh", k=rng.randrange(1, 6))), rng.choice(["x", "y", None]), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    mixes = [Counter(tuple(r) for r in mixing.mixed_documents(df.repartition(n)).collect()) for n in (1, 3, 8)]
    assert mixes[0] == mixes[1] == mixes[2]


def test_rows_that_differ_in_the_place_of_a_null_are_two(spark):
    rows = [(1, "a b", None, "z"), (1, "a b", "z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    keys = {(r["row_key"], r["row_key2"]) for r in mixing.mix_sources(df).collect()}
    assert len(keys) == 2


def test_mix_edge_cases(odd, none):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == len(odd_rows()) and mixing.mix_sources(none).collect() == []
    assert all(r["copies"] == 0 for r in rows if r["size"] == 0)
    by = {(r["doc_id"], r["size"]): r for r in rows}
    assert by[1, 0]["source"] is None and by[18, 2]["source"] == "b"
    taken = mixing.mixed_documents(odd)
    assert taken.columns == odd.columns
    assert taken.count() == sum(r["copies"] for r in rows)


# ---- quality

def test_quality_on_held_out_labels(spark, given):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.classify(given, labels).collect()}
    assert len(got) == given.count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    big = "/root/testdata/sf0.01"
    docs, marks = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    scored = {r["doc_id"]: r for r in quality.classify(docs, marks).collect()}
    held = [(scored[r["doc_id"]]["score"], r["quality"]) for r in marks.collect() if scored[r["doc_id"]]["held_out"]]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95


def test_machine_equals_all_pairs():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(quality.N_FEATURES, quality.RANK))
    w = rng.normal(size=quality.N_FEATURES)
    spots, values = np.array([3, 17, 99, 20_000 % quality.N_FEATURES]), rng.normal(size=4)
    out, _, _ = quality._raw_scores(0.5, w, v, spots, values, np.array([0]))
    plain = 0.5 + w[spots] @ values + sum(v[spots[i]] @ v[spots[j]] * values[i] * values[j] for i in range(4) for j in range(i))
    assert np.isclose(out[0], plain)


def test_quality_edge_cases(spark, odd, none):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (8, 1, None), (21, 0, 0), (11, 0, 0), (None, 1, 0), (13, None, 0)],
                                   "doc_id long, quality int, toxic int")
    assert quality.classify(odd, labels).count() == len(odd_rows())
    assert quality.classify(odd, labels.limit(0)).count() == len(odd_rows())
    assert quality.classify(none, labels).count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns


# ---- sharding

@pytest.mark.parametrize("table", ["odd", "given", "none"])
@pytest.mark.parametrize("bucket_bytes", [2000, 1 << 25])
def test_shards(table, bucket_bytes, request):
    docs = request.getfixturevalue(table)
    dealt = sharding.shuffle_into_shards(docs, 8, 17, bucket_bytes)
    rows = dealt.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(pairs(docs))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shuffle_into_shards(docs.repartition(5), 8, 17, bucket_bytes).collect()
    assert Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in again) == Counter(
        (r["doc_id"], r["text"], r["shard"], r["slot"]) for r in rows)
    wider = {(r["doc_id"], r["text"]): r["shard"] for r in sharding.shuffle_into_shards(docs, 9, 17, bucket_bytes).collect()}
    assert all(wider[r["doc_id"], r["text"]] in (r["shard"], 8) for r in rows)


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(0)
    seen = Counter(tuple(sharding.fisher_yates(4, rng)) for _ in range(24_000))
    assert len(seen) == 24 and max(abs(n - 1000) for n in seen.values()) < 150


def test_written_shards_read_back(spark, given, tmp_path):
    dealt = sharding.shuffle_into_shards(given, 4)
    sharding.write_shards(dealt, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    key = lambda df: Counter((r["doc_id"], r["shard"], r["slot"]) for r in df.collect())
    assert key(back) == key(dealt)


# ---- decontamination

def contamination_brute(rows, items):
    windows = defaultdict(set)
    for i, t in items:
        ws = words(t)
        n = min(13, len(ws))
        for at in range(len(ws) - n + 1 if n else 0):
            windows[tuple(ws[at:at + n])].add(i)
    out = []
    for i, t in rows:
        ws, hit, ids = words(t), set(), set()
        for n in {len(w) for w in windows}:
            for at in range(len(ws) - n + 1):
                found = windows.get(tuple(ws[at:at + n]))
                if found:
                    hit |= set(range(at, at + n))
                    ids |= found
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((i, len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


ITEMS = [(1, " ".join(odd_rows()[4][1].split()[20:50])), (2, "One two"), (10, "école ÉCOLE"), (None, "null id"), (3, None),
         (4, "!!!"), (5, " ".join(odd_rows()[4][1].split()[30:43])), (5, "w1 w2 w3 w4"), (6, "w1")]


@pytest.mark.parametrize("table", ["odd", "none"])
@pytest.mark.parametrize("limit", [10**6, 0])
def test_contamination(table, limit, spark, request, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_BROADCAST_WINDOWS", limit)
    docs = request.getfixturevalue(table)
    bench = spark.createDataFrame([(i, t, "k") for i, t in ITEMS], "item_id long, text string, words string")
    got = decontam.contamination(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=str) == contamination_brute(pairs(docs), ITEMS)
    kept = decontam.remove_documents(docs, bench)
    dirty = [x[0] for x in contamination_brute(pairs(docs), ITEMS) if x[5]]
    assert kept.count() == docs.count() - len(dirty) and kept.columns == docs.columns


def test_no_benchmark_leaves_all_clean(spark, odd):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(odd, bench).where("contaminated or n_hit > 0").count() == 0


def test_spans_are_cut_out(spark):
    item = " ".join(f"q{i}" for i in range(15))
    docs = documents(spark, [(1, f"Keep this, {item}! and that."), (2, "nothing here"), (3, None)])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontam.remove_spans(docs, bench).collect()}
    assert got == {1: "Keep this! and that.", 2: "nothing here", 3: None}


# ---- license scans

def base_brute(rows):
    out = []
    for i, t in rows:
        ws = words(t)
        starts, labels = [], set()
        for label, phrase in licenses.BASE:
            p = phrase.split()
            at = [k for k in range(len(ws) - len(p) + 1) if ws[k:k + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        out.append((i, len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    return sorted(out, key=str)


@pytest.mark.parametrize("table", ["odd", "given", "none"])
def test_base_phrases(table, request):
    docs = request.getfixturevalue(table)
    got = licenses.scan_licenses(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted((tuple(r) for r in got.collect()), key=str) == base_brute(pairs(docs))


def test_edited_quotes_are_found(spark):
    grant = dict((label, text) for label, text in licenses.TEMPLATES if text.startswith("redistribution"))["bsd"].split()
    edited = " ".join([*grant[:9], "extra", *grant[9:15], *grant[16:]])
    rows = [(1, "x y " + edited + " z"), (2, " ".join(grant[:8])), (3, "CC-BY, cc by; All  rights reserved"),
            (4, "GNU General Public License version"), (5, "permitted " * 50), (6, "cc by " * 3)]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(documents(spark, rows)).collect()}
    assert got[1]["labels"] == "bsd" and 0.8 <= got[1]["score"] < 1
    assert got[2]["labels"] == "" and got[5]["labels"] == ""
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"], got[3]["base_labels"]) == (3, 0, 4, "cc-by,reserved")
    assert got[4]["base_labels"] == "gpl" and got[6]["n_base"] == 3


# ---- passages

def test_compact_windows_hold_every_passage_once():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n, least = int(rng.integers(1, 60)), int(rng.integers(1, 9))
        values = rng.integers(0, 20, n).astype(np.uint64) << np.uint64(40)
        left, c, right = passages.compact_windows(values, np.array([0]), np.array([n]), least)
        held = Counter()
        for a, m, b in zip(left, c, right):
            assert b - a + 1 >= least and values[m] == values[a:b + 1].min()
            held.update((i, j) for i in range(a, m + 1) for j in range(m, b + 1) if j - i + 1 >= least)
        assert held == Counter((i, j) for i in range(n) for j in range(i + least - 1, n))


def test_passages_are_found(spark):
    rng = random.Random(6)
    shared = prose(rng, 55, 10**6)
    longer = prose(rng, 300, 10**6).split()
    edited = list(longer)
    edited[100] = "changed"
    rows = [(1, prose(rng, 200, 10**6) + " " + shared + " " + prose(rng, 90, 10**6)), (2, prose(rng, 40, 10**6) + " " + shared),
            (3, " ".join(longer)), (4, " ".join(edited)), (5, prose(rng, 500, 10**6)), (6, prose(rng, 30, 10**6)),
            (7, " ".join(longer)), (8, None), (9, ""), (None, prose(rng, 100, 10**6))]
    got = {r["doc_id"]: r for r in passages.passage_classes(documents(spark, rows)).collect()}
    assert {i: r["class_id"] for i, r in got.items()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 3, 8: 8, 9: 8, None: None}
    assert got[4]["linked_ids"] == [3] and got[7]["text_id"] == 3 and got[3]["linked_ids"] == [3, 4]
    assert got[8]["n_links"] == got[5]["n_links"] == 0
    links = passages.passage_links(documents(spark, rows)).collect()
    assert all(r["similarity"] >= 0.8 for r in links)
    spans = {(r["a_doc"], r["b_doc"]): (r["a_from"], r["a_to"]) for r in links} | {
        (r["b_doc"], r["a_doc"]): (r["b_from"], r["b_to"]) for r in links}
    assert spans[1, 2] == (200, 255)


def near_passage(a, b):
    """Whether two word lists share a stretch of 50 words, word by word."""
    grams = {tuple(a[i:i + 50]) for i in range(len(a) - 49)}
    return any(tuple(b[i:i + 50]) in grams for i in range(len(b) - 49))


def test_passages_of_the_given_documents(given):
    rows = [(i, re.findall(r"[^\x20\x09-\x0D]+", lowered(t))) for i, t in pairs(given)]
    got = {r["doc_id"]: r["class_id"] for r in passages.passage_classes(given).collect()}
    assert len(got) == len(rows)
    for (i, a), (j, b) in itertools.combinations(rows, 2):
        if near_passage(a, b) and a != b and len(set(a)) > 30:
            assert got[i] == got[j], (i, j)


def similar_somewhere(a, b):
    """Whether any two stretches of MIN_SHINGLES and a few more shingles are similar enough, by comparing all of them."""
    least = passages.MIN_SHINGLES
    for la, lb in itertools.product({least, len(a)}, {least, len(b)}):
        for i, j in itertools.product(range(len(a) - la + 1), range(len(b) - lb + 1)):
            x, y = set(a[i:i + la].tolist()), set(b[j:j + lb].tolist())
            if len(x & y) >= passages.SIMILARITY * len(x | y):
                return True
    return False


@pytest.mark.parametrize("n", [50, 52, 60, 89])
def test_one_edit_anywhere_in_a_short_passage(n):
    rng = random.Random(n)
    text = prose(rng, n, 10**6).split()
    before, behind = prose(rng, 30, 10**6).split(), prose(rng, 30, 10**6).split()

    def shingles(words_):
        return passages.shingle_hashes(passages.word_hashes(" ".join(words_), {}))

    for place in range(n):
        for edited in ([*text[:place], "changed", *text[place + 1:]], [*text[:place], "new", *text[place:]],
                       [*text[:place], *text[place + 1:]]):
            a, b = shingles(text), shingles([*before, *edited, *behind])
            places = {v: i for i, v in enumerate(b.tolist())}
            meets = [(i, places[v]) for i, v in enumerate(a.tolist()) if v in places]
            got = passages.passages_from(a, b, meets)
            assert bool(got) == similar_somewhere(a, b), (n, place, len(edited))
            for a0, a1, b0, b1, s in got:
                x, y = set(a[a0:a1].tolist()), set(b[b0:b1].tolist())
                assert min(a1 - a0, b1 - b0) >= passages.MIN_SHINGLES and s == len(x & y) / len(x | y) >= 0.8


def test_a_meeting_point_between_an_edge_and_inserted_words():
    rng = random.Random(5)
    text = prose(rng, 100, 10**6).split()
    inserted = [*text[:12], "one", *text[12:21], "two", *text[21:]]
    a, b = (passages.shingle_hashes(passages.word_hashes(" ".join(x), {})) for x in (text, inserted))
    assert a[14] == b[15]
    (found,) = passages.passages_from(a, b, [(14, 15)])
    assert found[:2] == (0, len(a)) and found[4] >= 0.8


def test_a_passage_edited_every_few_lines():
    rng = random.Random(8)
    text = prose(rng, 400, 10**6).split()
    edited = [f"e{i}" if i % 45 == 20 else w for i, w in enumerate(text)]
    a, b = (passages.shingle_hashes(passages.word_hashes(" ".join(x), {})) for x in (text, edited))
    meets = [(i, i) for i in range(len(a)) if a[i] == b[i]]
    (found,) = passages.passages_from(a, b, meets[:1])
    assert found[1] - found[0] > 300 and found[4] >= 0.8


def test_a_passage_that_others_quote_in_part(spark):
    rng = random.Random(12)
    rows, pairs_ = [], []
    for k in range(12):
        shared = prose(rng, 60, 10**6).split()
        # Parts of 40 words are too short to link; some of their keys are smaller than those of the two.
        for _ in range(12):
            at = rng.randrange(21)
            rows.append((len(rows), " ".join([prose(rng, 30, 10**6), *shared[at:at + 40], prose(rng, 30, 10**6)])))
        for _ in range(2):
            rows.append((len(rows), " ".join([prose(rng, 30, 10**6), *shared, prose(rng, 30, 10**6)])))
        pairs_.append((len(rows) - 2, len(rows) - 1))
    got = {r["doc_id"]: r["class_id"] for r in passages.passage_classes(documents(spark, rows)).collect()}
    expected = {i: i for i, _ in rows} | {j: i for i, j in pairs_}
    assert got == expected


def test_a_stretch_too_short_that_texts_repeat_ends_in_few_rounds(spark, monkeypatch):
    rng = random.Random(14)
    short = prose(rng, 34, 10**6)
    rows = [(i, " ".join(f"{short} {prose(rng, 60, 10**6)}" for _ in range(24))) for i in range(2)]
    rounds, verified = [], passages._verified
    monkeypatch.setattr(passages, "_verified", lambda *given: rounds.append(1) or verified(*given))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in passages.passage_classes(documents(spark, rows)).collect()}
    assert got == {0: (0, 0), 1: (1, 0)}
    assert len(rounds) <= 8


def test_passages_are_the_same_in_blocks_of_any_size(spark, monkeypatch):
    rng = random.Random(15)
    longer = prose(rng, 300, 10**6).split()
    rows = [(i, " ".join([prose(rng, 30, 10**6), *longer[at:at + 90], prose(rng, 30, 10**6)]))
            for i, at in enumerate((0, 0, 20, 40, 150, 160, 170, 210, 210, 5))]
    whole = sorted(passages.passage_links(documents(spark, rows)).collect())
    monkeypatch.setattr(passages, "BLOCK_TEXTS", 3)
    assert sorted(passages.passage_links(documents(spark, rows)).collect()) == whole != []


def test_every_two_texts_with_a_passage_in_common_are_linked(spark, monkeypatch):
    rng = random.Random(16)
    shared, other = prose(rng, 120, 10**6).split(), prose(rng, 80, 10**6).split()
    rows = [(i, " ".join([prose(rng, 30, 10**6), *shared[:20 + 9 * i], "changed", *shared[21 + 9 * i:], prose(rng, 30, 10**6)])) for i in range(9)]
    rows += [(9, " ".join([*shared, *other])), (10, " ".join([prose(rng, 20, 10**6), *other]))]
    expected = {i: [j for j in range(10) if j != i] for i in range(9)} | {9: [*range(9), 10], 10: [9]}
    for texts in (256, 2):  # one block; parts of few texts that share their smallest key
        monkeypatch.setattr(passages, "BLOCK_TEXTS", texts)
        got = {r["doc_id"]: (r["linked_ids"], r["n_links"]) for r in passages.passage_classes(documents(spark, rows)).collect()}
        assert got == {i: (x, len(x)) for i, x in expected.items()}


@pytest.mark.parametrize("table", ["odd", "none"])
def test_passages_edge_cases(table, request):
    docs = request.getfixturevalue(table)
    rows = passages.passage_classes(docs).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in pairs(docs))
    if rows:
        by = {r["doc_id"]: r["class_id"] for r in rows}
        assert by[5] == by[6] == by[8] == by[20] == by[22] and by[9] == by[10]


# ---- pipeline and registered queries

def test_pipeline_stage_by_stage(spark, given):
    docs, labels = given, spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = {r["doc_id"]: r["predicted"] for r in quality.classify(docs, labels).collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, FOLDER).cache()
    assert {r["doc_id"] for r in good.collect()} == {i for i, p in scores.items() if p}
    single = stages["near_duplicates"](spark, good, FOLDER).cache()
    groups = {r["component_id"] for r in simhash.simhash_components(good, 3, 2).collect()}
    assert {r["doc_id"] for r in single.collect()} == groups
    clean = stages["benchmark"](spark, single, FOLDER).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {x[0] for x in contamination_brute(pairs(single), items) if x[5]}
    assert {r["doc_id"] for r in clean.collect()} == groups - dirty
    mixed = stages["mixing"](spark, clean, FOLDER).cache()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(clean).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: c for i, c in copies.items() if c})
    for df in (good, single, clean, mixed):
        assert df.columns == given.columns
    dealt = stages["sharding"](spark, mixed, FOLDER).collect()
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(map(str, dealt)) == Counter(map(str, whole)) and len(dealt) == mixed.count()


def test_registered_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
