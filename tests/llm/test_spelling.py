"""Spelling variants against brute force over all pairs of words, counts against plain Python, awkward rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from pairloom.llm import queries, spelling
from tests.llm import cases

SCHEMA = "word string, n long"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, factor=10):
    found = {w: [v for v in words if near(v, w)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x), default=None) for w, v in found.items()}
    form = {w: b if b and words[b] >= factor * words[w] else None for w, b in best.items()}
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(found[w]), words.get(form[w])))
    return sorted(out)


def invented(seed, letters="abé\xff", size=60):
    """Few letters, so runs of one letter, chains of forms and ties are common."""
    rng = random.Random(seed)
    words = {}
    for _ in range(size):
        base = [rng.choice(letters) for _ in range(rng.randrange(1, 9))]
        for _ in range(8):
            word = list(base)
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(word) + 1)
                word[at : at + rng.randrange(2)] = rng.choice(["", rng.choice(letters)])
            if word:
                words["".join(word)] = rng.choice([1, 1, 2, 3, 10, 20, 30, 100, 300, 1000, 3000])
    return words


def solve(spark, words):
    return sorted(tuple(r) for r in spelling.variants(spark.createDataFrame(list(words.items()), SCHEMA)).collect())


def test_equals_brute_force(spark):
    words = invented(1) | invented(2, "\U0001f600漢x", 20)
    long = "ab" * 2000
    words |= {long: 5, long + "a": 500, long[:100] + long[101:]: 50}
    assert solve(spark, words) == brute(words)


def test_one_word_and_none(spark):
    assert solve(spark, {"lonely": 3}) == [("lonely", None, "lonely", 3, 0, None)]
    assert solve(spark, {}) == []


def test_numbers_grow_with_the_order_and_shared_nodes_agree(spark):
    words = spark.createDataFrame([(w,) for w in invented(5)], "word string")
    rows = spelling.trie_paths(words, 7, "trie").collect()
    numbers = {}
    for row in rows:
        for k, number in enumerate(row.path):
            assert numbers.setdefault(number, row.word[: k + 1]) == row.word[: k + 1]
    assert len(set(numbers.values())) == len(numbers)
    last = [r.path[-1] for r in sorted(rows, key=lambda r: r.word)]
    assert last == sorted(last)
    owners = Counter(number for row in rows for number in row.path)
    assert all(owners[number] == 1 for row in rows for number in row.path[row.shared :])


def plain_counts(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                out[run] += 1
    return out


def test_counts(spark):
    rng = random.Random(8)
    letters = "aBc×Éÿzß"
    rows = [(rng.choice([i, i, None]), " ".join("".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(300))) for i in range(40)]
    rows += rows[:3] + [(r[0], r[1]) for r in cases.ROWS]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = spelling.counts(frame, 7, spelling.dropped_letter).collect()
    assert {r.word: r.n for r in found} == plain_counts(rows)


def test_awkward_tables(spark, tmp_path):
    folder = cases.folder(spark, tmp_path / "some")
    rows = queries.QUERIES["op13_spelling_variants"](spark, folder).collect()
    words = {w: n for w, n in plain_counts([(r[0], r[1]) for r in cases.ROWS]).items() if n >= 2}
    assert sorted(tuple(r) for r in rows) == brute(words)
    assert queries.QUERIES["op13_spelling_variants"](spark, cases.folder(spark, tmp_path / "none", [])).count() == 0
