"""Substring dedup against brute force over all windows, on awkward rows and on nothing."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pairloom.llm import substrings
from tests.llm import cases

SCHEMA = "doc_id long, text string"


def brute(rows, width):
    """(doc_id, words, removed, kept text) by the first document of every window."""
    split = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    key = lambda i: (i is None, i or 0)
    low = {}
    for i, words in split:
        for a in range(len(words) - width + 1):
            window = tuple(words[a : a + width])
            low[window] = min(low.get(window, key(i)), key(i))
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for a in range(len(words) - width + 1):
            if low[tuple(words[a : a + width])] < key(i):
                gone[a : a + width] = [True] * width
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=str)


def passages(seed):
    """Texts put together from pieces of others, some of few different words, with ids that repeat or are missing."""
    rng = random.Random(seed)
    sources = [[f"w{rng.randrange(30 if b % 2 else 3000)}" for _ in range(rng.randrange(5, 400))] for b in range(40)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(1, 4)):
            source = rng.choice(sources)
            a = rng.randrange(len(source))
            words += source[a : rng.randrange(a, len(source) + 1)] + [f"x{rng.randrange(9)}"]
        rows.append((rng.choice([i, i, i, None, i // 2]), rng.choice([" ", "\n", "  \t"]).join(words)))
    return rows + [(300 + i, "a b " * 300) for i in range(3)] + [(r[0], r[1]) for r in cases.ROWS]


@pytest.mark.parametrize("width", [50, 20, 1])
def test_equals_brute_force(spark, width):
    rows = passages(width)
    found = substrings.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), width).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, width)


def test_awkward_tables(spark):
    assert substrings.without_repeats(cases.empty(spark)).count() == 0
    found = substrings.without_repeats(cases.docs(spark)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute([(r[0], r[1]) for r in cases.ROWS], 50)


def test_sketch_overestimates(spark):
    """With far too few counters more is estimated repeated, but never less."""
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**62, 4000)
    reps = spark.createDataFrame([(int(v),) for v in [*values, *values[:500]]], "rep long").repartition(7)
    twice = set(values[:500].tolist())
    sizes = []
    for counters in (64, 1 << 14):
        merged = substrings.sketch(reps, 4, counters)
        found = {r.rep for r in substrings.repeated(reps, merged, 4, counters).collect()}
        assert twice <= found
        sizes.append(len(found))
    assert sizes[1] < 600 < sizes[0]


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 99, 60).astype(np.uint64)
    for width in (1, 2, 3, 7, 35):
        expected = [min(values[i : i + width]) for i in range(60 - width + 1)]
        assert substrings.sliding_min(values, width).tolist() == expected
