"""Token files, packing and the encoder below them: exact round trips."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import packing, queries, tokenfiles
from pairloom.llm.tokenizing import CutEncoder
from tests.llm import cases

VOCABULARIES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ENCODERS = {name: CutEncoder(queries.tokenizer_path(name), limit=50) for name in VOCABULARIES}


def reference(name, text, end):
    return np.append(np.frombuffer(ENCODERS[name].plain(text or ""), np.uint32), end).astype("<u4")


@pytest.mark.parametrize("name", VOCABULARIES)
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="aAbé ß'sS.,!|*\n\t  12<|endoftext|>́ΣİĞ漢\U0001f600\x00\x1c\x85", max_size=40), max_size=4))
def test_cuts_change_no_id(name, texts):
    encoder = ENCODERS[name]
    ids, counts = encoder.encode_all(pa.array(texts, pa.string()))
    expected = [np.frombuffer(encoder.plain(t), np.uint32) for t in texts]
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x.tolist()]


@pytest.mark.parametrize("bits", [False, True])
@settings(max_examples=40, deadline=None)
@given(ids=st.lists(st.integers(0, 2**32 - 1), max_size=70), block=st.integers(1, 40))
def test_segments_round_trip(bits, ids, block):
    counts = np.array([len(ids) // 2, 0, len(ids) - len(ids) // 2], np.int64)
    raw = tokenfiles.pack_segment(np.array([-1, 0, 5]), np.array([0, 1, 0]), counts, np.array(ids, np.uint32), block, bits)
    doc_ids, null, found, back = tokenfiles.unpack_segment(raw)
    assert (doc_ids.tolist(), null.tolist(), found.tolist(), back.tolist()) == ([-1, 0, 5], [0, 1, 0], counts.tolist(), ids)


def test_files_hold_all_ids_in_order(spark, tmp_path):
    path = tokenizer = queries.tokenizer_path(VOCABULARIES[0])
    tokenfiles.write_tokens(cases.docs(spark), f"{tmp_path}/t", path, segment_ids=500, block=64, bits=True)
    files = spark.read.parquet(f"{tmp_path}/t")
    assert files.count() > 3 and tokenizer
    rows = sorted(tokenfiles.read_tokens(files).collect(), key=lambda r: r.start)
    order = sorted(cases.ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for row, (doc_id, text, *_) in zip(rows, order, strict=True):
        ids = reference(VOCABULARIES[0], text, 0)
        assert (row.doc_id, row.start, row.n_tokens, bytes(row.ids)) == (doc_id, at, len(ids), ids.tobytes())
        at += len(ids)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 30_000))
def test_cuts_of_a_document(n):
    lengths = packing.cuts(n)
    assert sum(lengths) == n
    assert all(x & (x - 1) == 0 for x in lengths[:-1]) and (lengths[-1] <= 64 or lengths[-1] & (lengths[-1] - 1) == 0)


def check_packing(rows, docs, name):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r.doc_id, r.ids_crc32 if r.doc_id is None else 0)].append(r)
        by_sequence[r.sequence_id].append(r)
    total = pad = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
        total += at
        pad += 0 if at & (at - 1) == 0 else 4096 - at
    assert total == sum(len(reference(name, r[1], 2)) for r in docs)
    return pad


def test_packing_loses_nothing(spark, tmp_path):
    path = cases.folder(spark, tmp_path / "t")
    rows = queries.op5_pack_harmonic(spark, path).collect()
    assert check_packing(rows, cases.ROWS, VOCABULARIES[1]) <= 4096
    ids = {r[0]: reference(VOCABULARIES[1], r[1], 2) for r in cases.ROWS}
    for r in rows:
        if r.doc_id is not None:
            assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
            assert r.doc_tokens == len(ids[r.doc_id])
    many = [(i, " ".join(["a"] * (i % 200)), "en", "a", 1) for i in range(3000)]
    rows = packing.pack(cases.docs(spark, many), queries.tokenizer_path(VOCABULARIES[1])).selectExpr("*", "crc32(ids) AS ids_crc32").collect()
    pad = check_packing(rows, many, VOCABULARIES[1])
    assert pad < 0.05 * sum(r.length for r in rows)
    bins = defaultdict(set)
    for r in rows:
        bins[r.sequence_id].add(r.length)
    assert sum(len(x) == 1 for x in bins.values()) > 0.6 * len(bins)  # the rest closes what each length leaves over


def test_nothing_gives_nothing(spark, tmp_path):
    path = cases.folder(spark, tmp_path / "none", [])
    assert queries.op2_token_planes(spark, path).count() == 0
    assert queries.op5_pack_harmonic(spark, path).count() == 0
