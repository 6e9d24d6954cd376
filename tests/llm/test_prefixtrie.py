"""The conversation trie against a dictionary of prefixes, at every cap, on awkward rows and on nothing."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from pairloom.llm import prefixtrie, queries

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        words = len(p[-1][1].encode().split()) if p else 0
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[x] for x in below)
        ids = ",".join(map(str, sorted(c for c in members[p] if built[c] == p)))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), parent, len(members[p]), len(below), leaves[p], saved[p], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def solve(spark, rows, cap=None):
    found = prefixtrie.build(spark.createDataFrame(rows, SCHEMA).repartition(3), cap)
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


def invented(seed, convs=250):
    """Few different turns, so prefixes are shared, conversations repeat, and chains branch late."""
    rng = random.Random(seed)
    common = [("user", f"t {i} " * rng.randrange(4)) for i in range(3)]
    rows = []
    for c in rng.sample(range(-60, 500), convs):
        start = [common[0]] * 2 if rng.random() < 0.5 else []
        turns = start + [rng.choice(common) for _ in range(rng.randrange(1, 6))]
        rows += [(c, rng.choice([i, i, None]), r, t) for i, (r, t) in enumerate(turns)]
    long = [(7, i, None, "same" if i < 400 else "other") for i in range(500)] + [(8, i, "", "same") for i in range(450)]
    odd = [(None, 1, "user", "x"), (3, None, None, None), (3, None, None, None), (3, 1, "ü", "\x00 漢字"), (4, 5, "a", " \t "), (1 << 60, 1, "u", "big")]
    return rows + long + odd


@pytest.mark.parametrize("cap", [None, 1, 5, 40])
def test_equals_brute_force(spark, cap):
    rows = invented(cap or 9)
    assert solve(spark, rows, cap) == brute(rows)


def test_empty_tables(spark):
    assert solve(spark, []) == []
    assert solve(spark, [(None, 1, "a", "b")]) == []
    assert solve(spark, [(5, 1, "a", "b c")]) == brute([(5, 1, "a", "b c")])


def test_perfect_slots():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2)).astype(np.uint64)
    hashed = prefixtrie.PerfectSlots(keys)
    assert sorted(hashed.slots(keys)) == list(range(5000))
    assert (hashed.slots(keys + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError):
        prefixtrie.PerfectSlots(np.zeros((2, 2), np.uint64))


def test_query_looks_at_no_other_columns(spark, tmp_path):
    rows = [(c, i, "user", f"t{i % 2}") for c in range(30) for i in range(c % 5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("place", "words", "d1", "depth", "n_convs", "shard", "upto"):
        frame = frame.withColumn(name, F.lit("other"))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op12_prefix_trie"](spark, str(tmp_path))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)
