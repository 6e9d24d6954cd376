"""Classifier, context-tree weighting and perplexity rules: against slow versions, on awkward rows and on nothing."""

from __future__ import annotations

import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import classifier, common, ctw, perplexity, queries
from pairloom.llm.flat import FlatTexts
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="abA *#é漢\n\t\x0b\x00", max_size=30), max_size=5)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    return cases.folder(spark, tmp_path_factory.mktemp("models"))


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_flat_texts_find_the_words(texts):
    flat = FlatTexts(pa.array([t.encode() for t in texts], pa.binary()))
    words = [w.encode() for t in texts for w in WORD.findall(t)]
    assert [flat.data[a:b].tobytes() for a, b in zip(flat.starts, flat.ends)] == words
    assert flat.words.tolist() == [len(WORD.findall(t)) for t in texts]
    hashes = dict(zip(words, flat.hashes.tolist()))
    assert [hashes[w] for w in words] == flat.hashes.tolist() and len(set(hashes.values())) == len(hashes)


def rules(text):
    words, where = WORD.findall(text), {}
    for i in range(len(words) - 2):
        where.setdefault(tuple(words[i : i + 3]), []).append(i)
    inside = {i + k for v in where.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_base_rules(texts):
    found = perplexity.base_rules(FlatTexts(pa.array([t.encode() for t in texts], pa.binary())))
    assert list(zip(*[found[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])) == [rules(t) for t in texts]


def test_kneser_ney_sums_to_one():
    rng = random.Random(1)
    gram = Counter(rng.randrange(5) + 48 * rng.randrange(4) + 48**2 * rng.randrange(3) + 48**3 * rng.randrange(3) for _ in range(400))
    model = perplexity.estimate(np.array(list(gram)), np.array(list(gram.values())))
    for context in [0, 1 + 48 * 2, 2 + 48 + 48**2, 47 + 48 * 47 + 48**2 * 47]:
        p = 2.0 ** perplexity.log2_of(model, np.arange(48) + 48 * context)
        assert p.sum() == pytest.approx(1, abs=1e-4)
    counts = np.array([1, 1, 1, 2, 2, 3, 4, 9])
    y = 3 / (3 + 2 * 2)
    assert perplexity._discounts(counts)[1:] == pytest.approx([1 - 2 * y * 2 / 3, min(2 - 3 * y / 2, 1.99), min(3 - 4 * y, 2.99)])


def test_perplexity_rules_reject_other_text(spark, awkward, tmp_path):
    rows = queries.op9_perplexity_rules(spark, awkward).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == Counter((r[0], *rules(r[1] or "")) for r in cases.ROWS)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    rng = random.Random(3)
    parts = ["lo", "ra", "mi", "ten", "sul", "ve", "dor"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))
    clean = [(i, " ".join(word() for _ in range(rng.randrange(60, 200))), "en" if i % 2 else None, "a", 1) for i in range(300)]
    odd = [(1000 + i, " ".join(word() + rng.choice(["***", "$$$", "&&&"]) for _ in range(80)), "en", "a", 1) for i in range(5)]
    kept = {r.doc_id: r.kept for r in perplexity.judge(cases.docs(spark, clean + odd)).collect()}
    assert all(kept[r[0]] for r in clean) and not any(kept[r[0]] for r in odd)


def test_perplexity_is_of_all_bytes_and_six_of_them(spark, monkeypatch):
    """Bits of texts dealt out in batches, against one model in memory; nothing is folded, and five bytes back count."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["Lo", "lo", "été", "ÉTÉ", "漢字", "x;y", "x:y", "ramiten"]) for _ in range(rng.randrange(30))) for _ in range(40)]
    texts += [None, "", " \n", "\x00 a\tb\n\nc", "a" * 300]
    monkeypatch.setattr(perplexity, "BATCH_BYTES", 500)
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r.bits for r in perplexity.measure(docs).collect()}

    def keys(text):
        data = b" " * 5 + b"".join(w.encode() + b" " for w in WORD.findall(text or ""))
        return [int.from_bytes(data[i - 5 : i + 1], "big") for i in range(5, len(data))]

    count = Counter(k for t in texts for k in keys(t))
    model = perplexity.estimate(np.array(list(count)), np.array(list(count.values())), 6, 256)
    for i, text in enumerate(texts):
        want = -perplexity.log2_of(model, np.array(keys(text), np.int64), 256).sum()
        assert got[i] == pytest.approx(want, abs=len(keys(text)) / 4096)


def kt(n0, n1):
    p = 1.0
    for k, (count, other) in enumerate([(i, 0) for i in range(n0)] + [(j, n0) for j in range(n1)]):
        p *= (count + 0.5) / (k + 1)
    return p


def brute_ctw(train, word):
    """log10 probability of a word (bytes) by the definition, over dictionaries of contexts."""
    bits: dict = {}

    def path(w, i):
        data = w + (b"" if w == b"\n" else b" ")
        before = b" " + w[:i]
        short = [before[len(before) - d :] for d in range(min(len(before), 6) + 1)]
        return data, short + ([("all", before)] if len(before) > 6 else [])

    def steps(w):
        for i in range(len(w) + (w != b"\n")):
            data, contexts = path(w, i)
            for k in range(8):
                yield contexts, (1 << k) | (data[i] >> (8 - k)), (data[i] >> (7 - k)) & 1

    longer: dict = {}
    for w in train:
        for contexts, node, bit in steps(w):
            for c, d in itertools.zip_longest(contexts, contexts[1:]):
                bits.setdefault((c, node), [0, 0])[bit] += 1
                if d is not None:
                    longer.setdefault(c, set()).add(d)

    def weighted(c, node):
        if (c, node) not in bits:
            return 1.0
        own = kt(*bits[c, node])
        if c not in longer:
            return own
        return 0.5 * own + 0.5 * math.prod(weighted(d, node) for d in longer[c])

    def one(contexts, node):
        n0, n1 = bits.get((contexts[0], node), (0, 0))
        if n0 + n1 == 0:
            return None
        own = (n1 + 0.5) / (n0 + n1 + 1)
        if contexts[0] not in longer or len(contexts) == 1:
            return own
        share = 0.5 * kt(n0, n1) / weighted(contexts[0], node)
        below = one(contexts[1:], node)
        return own if below is None else share * own + (1 - share) * below

    out = 0.0
    for contexts, node, bit in steps(word):
        p = one(contexts, node)
        p = 0.5 if p is None else p
        out += math.log10(p if bit else 1 - p)
    return out


def tokens(text):
    return [w.encode() for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))] + [b"\n"]


def test_context_tree_weighting_is_what_it_says(spark):
    texts = ["the cat Sat on the mat", "the the theatrical theatre", "a cat, theatricals", "zebra theatrical", "", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in ctw.score(docs, docs.doc_id < 3).collect()}
    train = [w for t in texts[:3] for w in tokens(t)]
    known = Counter(train)
    for i, text in enumerate(texts):
        words = tokens(text)
        assert (rows[i].n_tokens, rows[i].train_tokens) == (len(words), len(train))
        assert rows[i].n_known == sum(w in known for w in words)
        base = sum(math.log10((known[w] + 1) / (len(train) + len(known) + 1)) for w in words)
        assert rows[i].base_score == pytest.approx(base)
        assert rows[i].score == pytest.approx(sum(brute_ctw(train, w) for w in words), rel=1e-5)
        assert rows[i].n_bytes == sum(len(w) + (w != b"\n") for w in words)
        assert rows[i].bits_per_byte == pytest.approx(-rows[i].score / math.log10(2) / rows[i].n_bytes)


def test_a_bucket_of_many_contexts_needs_little_memory_at_once():
    """The same numbers as from one tree over all pairs, to the last bit, with a bound on the bytes held by pair."""
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 12, 12_000)
    pairs, counts = np.unique(ctw.word_pairs(rng.integers(97, 123, lengths.sum()).astype(np.uint8), lengths)[0], return_counts=True)
    counts[::5] = 0
    whole = ctw.Subtree(pairs, counts)
    top = ctw.Top(whole.tops())
    want = whole.log10(top).astype("<f4")
    parts = ctw.tops(pairs, counts, 1000)
    assert (parts[["one", "node", "n0", "n1"]] == whole.tops()[["one", "node", "n0", "n1"]]).all(None)
    assert np.allclose(parts["ln_longer"], whole.tops()["ln_longer"], rtol=1e-12)
    del whole
    tracemalloc.start()
    found = ctw.log10(pairs, counts, top, 1000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found == want).all()
    assert peak < 200 * len(pairs)


def test_context_tree_weighting_on_awkward_rows(spark, awkward, monkeypatch):
    monkeypatch.setattr(ctw, "BATCH_BYTES", 1)
    rows = queries.op4_context_tree_weighting(spark, awkward).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((r[0], len(tokens(r[1]))) for r in cases.ROWS)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 7 == 2) and r.score < 0 for r in rows)


def test_classifier_learns_repetition_and_signs(spark, awkward):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["lo", "ra", "mi", "ten", "sul"]) for _ in range(rng.randrange(1, 5)))
    good = [" ".join(word() for _ in range(60)) for _ in range(150)]
    bad = [" ".join(word() + "***" for _ in range(60)) for _ in range(50)] + [" ".join([word()] * 5 + [word()] * 5) * 6 for _ in range(50)]
    texts = good + bad
    docs = cases.docs(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(len(texts)) if i % 2], "doc_id long, quality int, toxic int")
    rows = classifier.score(docs, classifier.learn(docs, labels)).collect()
    right = [(r.score >= 0.5) == (r.doc_id < 150) for r in rows if r.doc_id % 2 == 0]
    assert sum(right) >= 0.95 * len(right) and rows[0].__fields__[:5] == docs.columns[:5]
    found = queries.op1_quality_classifier(spark, awkward).collect()
    assert len(found) == len(cases.ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    by_text = {}
    for r in found:
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert by_text[1] == by_text[2]


def test_without_labels_scores_are_even(spark):
    docs = cases.docs(spark, cases.ROWS[:3])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in classifier.score(docs, classifier.learn(docs, labels)).collect()} == {0.5}


def test_nothing_gives_nothing(spark, tmp_path):
    path = cases.folder(spark, tmp_path / "none", [])
    for name in ("op1_quality_classifier", "op4_context_tree_weighting", "op9_perplexity_rules"):
        assert queries.QUERIES[name](spark, path).count() == 0
    assert common.crc_mod is not None
