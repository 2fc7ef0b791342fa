import random

import pytest

from conftest_llm import documents, prose
from marquee.llm import licenses as L


def chain_by_hand(matches):
    """Longest rising choice, by the square of the matches."""
    matches = sorted(matches)
    best = []
    for i, (a, o) in enumerate(matches):
        best.append(1 + max((best[j] for j in range(i) if matches[j][0] < a and matches[j][1] < o), default=0))
    return max(best, default=0)


def test_longest_chain():
    rng = random.Random(5)
    for _ in range(300):
        matches = list({(rng.randrange(12), rng.randrange(12)) for _ in range(rng.randrange(0, 20))})
        chain = L.longest_chain(matches)
        assert len(chain) == chain_by_hand(matches) and set(chain) <= set(matches)
        assert all(a < b and x < y for (a, x), (b, y) in zip(chain, chain[1:]))


def scanned(spark, texts, **settings):
    rows = [(i, t) for i, t in enumerate(texts)]
    return {r["doc_id"]: (r["labels"], r["score"]) for r in L.scan_licenses(documents(spark, rows), **settings).collect()}


@pytest.fixture(scope="module")
def quotes(spark):
    """Every template in full, with a lost word in ten, with a strange word in ten, backwards, scattered and cut in half."""
    rng = random.Random(9)
    texts, want = [], []
    for label, text in L.TEMPLATES:
        words = L.template_words(text)
        n = len(words)
        pairs = list(zip(words, words[1:]))
        backwards = " ".join(f"{a} {b}" for a, b in reversed(pairs))
        scattered = " ".join(f"{a} {b} filler{i}" for i, (a, b) in enumerate(pairs))
        texts += [prose(rng, 40) + " " + text.upper() + " " + prose(rng, 40), backwards, scattered, " ".join(words[:n // 2])]
        want += [(label, True), (label, False), (label, False), (label, False)]
        if n > 30:
            texts += [" ".join(w for i, w in enumerate(words) if i % 20 != 7), " ".join(w + " strange" * (i % 20 == 7) for i, w in enumerate(words))]
            want += [(label, True), (label, True)]
    return texts, want


def test_quotes_are_found_and_scrambled_words_are_not(spark, quotes):
    texts, want = quotes
    # Each template under a name of its own, so that no other one answers for it.
    numbered = [(f"t{i}", text) for i, (_, text) in enumerate(L.TEMPLATES)]
    got = scanned(spark, texts, templates=numbered, base=[])
    at, which = 0, -1
    for i, (_, found) in enumerate(want):
        if at == 0:
            which += 1
            at = 6 if len(L.template_words(L.TEMPLATES[which][1])) > 30 else 4
        at -= 1
        assert (f"t{which}" in got[i][0].split(",")) == found, (L.TEMPLATES[which], texts[i][:80], got[i])
    assert all(0 <= score <= 1 for _, score in got.values())


def test_quotes_far_apart_do_not_add_up(spark):
    words = L.template_words(dict(L.TEXTS)["mit"])
    n = len(words)
    rng = random.Random(2)
    apart = " ".join(words[:n // 2]) + " " + prose(rng, 4 * n) + " " + " ".join(words[n // 2:])
    twice = " ".join(words) + " " + prose(rng, 30) + " " + " ".join(words)
    got = scanned(spark, [apart, twice, " ".join(words)], templates=L.TEXTS, base=[])
    assert got[0] == ("", 0.0) and got[1] == got[2] == ("mit", 1.0)


def test_spans_of_repeated_quotes():
    words = 10
    votes = [(5, list(range(9))), (40, list(range(9)))]
    assert L.verified_spans(votes, words) == [(5, 14, 10), (40, 49, 10)]
    assert L.verified_spans([(5, [0, 1, 2]), (6, [0, 5, 7])], words) == [(5, 14, 8)]
    assert L.verified_spans([(5, [0, 1, 2]), (6, [0, 5])], words) == []
