"""Accumulator-limited ranking against scores of every document."""

import math
import random
from collections import Counter

import pytest

from snapfold.llm import ranking

WORDS = [f"w{i}" for i in range(60)]


def brute(docs, items, k=10):
    import regex

    find = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in regex.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t or "")]
    held = [(i, Counter(w), len(w)) for i, t in docs if (w := find(t))]
    n, length = len(held), sum(h[2] for h in held)
    df = Counter(t for h in held for t in h[1])
    out = []
    for item, text in items:
        scored = []
        for i, tf, size in held:
            m = 25 + 75 * size * n // length
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t, q in Counter(find(text)).items() if t in tf)
            if s > 0:
                scored.append((-s, i if i is not None else math.inf))
        out += [(item, r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(WORDS, weights, k=rng.choice([1, 5, 30, 200])))) for i in range(700)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)] + [(3, docs[4][1]), (None, docs[5][1]), (2000, None), (2001, ""), (2002, "-- !"), (2003, "W1, É1 w1Ω\nw59")]
    docs.append((2004, " ".join(rng.choices(WORDS, k=30000))))
    items = [(i, " ".join(rng.choices(WORDS, weights, k=rng.choice([1, 3, 20])))) for i in range(25)] + [(25, "É1 w1ω w1Ω"), (26, "unheard"), (27, None), (28, ""), (3, "w0 w0 w1"), (None, "W7")]
    return docs, items


@pytest.mark.parametrize("block", [50, 1 << 21])
def test_against_every_score(spark, corpus, block, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(ranking, "BLOCK", block)
    a = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, rank int").repartition(3)
    got = ranking.search(a, spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_groups_of_items(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(ranking, "GROUP", 12)
    got = ranking.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 3).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, 3)


def test_accumulators_are_limited():
    """A rare term gives the best documents away: those that have only the common one get no accumulator."""
    import numpy as np

    n = 10_000
    owners = np.append(np.arange(20), np.arange(n))
    codes, counts = np.append(np.zeros(20, int), np.ones(n, int)), np.ones(n + 20, int)
    block = ranking.Postings(np.arange(n), np.full(n, 10), owners, codes, counts, np.array([6000, 5]), n, 10 * n)
    query = ranking.Query(0, np.array([0, 1]), np.array([1, 1]))
    at, scores, made = block.best(query, 10, 0)
    assert made == 20 and len(at) == 20
    assert set(scores) == {int(block.adds[0] + block.adds[-1])}
    assert block.best(query, 10, int(scores[0]) + 1)[2] == 0 and not block.scores.any() and not block.seen.any()
