"""Exact dedup, sharding and mixing: against plain Python, on awkward rows and on nothing."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pairloom.llm import exactdedup, mixing, queries, sharding
from tests.llm import cases


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    return cases.folder(spark, tmp_path_factory.mktemp("awkward"))


def plain(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_exact_dedup_decides_as_defined(spark, awkward):
    groups = defaultdict(list)
    for doc_id, text, *_ in cases.ROWS:
        groups[plain(text)].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    expected = Counter()
    for text, rows in groups.items():
        keep = min(rows)[-1]
        for row in rows:
            expected[(row[-1], keep, len(rows), row[-1] == keep, hashlib.sha256(text.encode()).hexdigest())] += 1
    found = queries.op8_exact_dedup(spark, awkward).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert Counter(map(tuple, found)) == expected


def test_index_persists_between_batches(spark):
    index = exactdedup.DigestIndex(spark, "test_digest_index", buckets=4)
    spark.sql("DROP TABLE IF EXISTS test_digest_index")
    try:
        schema = "doc_id long, text string"
        first = index.add(spark.createDataFrame([(5, "a b"), (6, "c")], schema), "one").collect()
        assert all(r.kept for r in first)
        second = index.add(spark.createDataFrame([(1, "a  b"), (2, "d"), (3, "d ")], schema), "two")
        assert {(r.doc_id, r.keep_id, r.kept) for r in second.collect()} == {(1, 5, False), (2, 3, False), (3, 3, True)}
        third = exactdedup.new_rows(index, spark.createDataFrame([(9, "d"), (8, "e"), (8, "e")], schema), "three")
        assert [tuple(r) for r in third.collect()] == [(8, "e")]
        assert index.read().count() == 4
        plan = index.new(exactdedup.candidates(exactdedup.digests(spark.createDataFrame([(1, "x")], schema))))._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "LeftAnti" in plan
    finally:
        spark.sql("DROP TABLE test_digest_index")


def test_waves_change_no_decision(spark):
    names = ["test_one_wave", "test_three_waves"]
    found = []
    try:
        for name, waves in zip(names, (1, 3)):
            index = exactdedup.DigestIndex(spark, name, buckets=4)
            rows = index.add(cases.docs(spark), "all", waves=waves).collect()
            found.append((Counter(map(str, rows)), sorted(map(str, index.read().collect()))))
            again = index.add(cases.docs(spark), "all", waves=waves).collect()
            assert Counter(map(str, again)) == found[-1][0] and index.read().count() == len(found[-1][1])
        assert found[0] == found[1]
        plan = index.new(exactdedup.candidates(exactdedup.digests(cases.docs(spark))))._jdf.queryExecution().executedPlan().toString()
        right = plan[plan.index("SortMergeJoin") :].split("\n:- ")[0] if "\n:- " in plan else plan
        assert "LeftAnti" in right and plan.count("hashpartitioning") <= 2  # the candidates' own; the index has its buckets
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_new_rows_keep_all_columns(spark):
    index = exactdedup.DigestIndex(spark, "test_digest_rows", buckets=2)
    try:
        rows = exactdedup.new_rows(index, cases.docs(spark), "all")
        assert rows.columns == cases.docs(spark).columns
        texts = [plain(r.text) for r in rows.collect()]
        assert len(texts) == len(set(texts)) == len({plain(r[1]) for r in cases.ROWS})
    finally:
        spark.sql("DROP TABLE IF EXISTS test_digest_rows")


def test_sharding_is_dense_and_moves_little(spark, awkward):
    rows = queries.op10_shard_by_rendezvous(spark, awkward).collect()
    assert len(rows) == len(cases.ROWS)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in cases.ROWS)
    assert texts == Counter((r.doc_id, r.size, r.text_crc32) for r in rows)


def test_shares_follow_weights(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    counts = {r["shard"]: r["count"] for r in sharding.assign(docs, [1.0, 3.0, 4.0]).groupBy("shard").count().collect()}
    assert [round(counts[i] / 20_000, 1) for i in range(3)] == [0.1, 0.4, 0.5]
    before = sharding.assign(docs, [1.0, 3.0, 4.0]).select("doc_id", "shard")
    after = sharding.assign(docs, [1.0, 3.0, 8.0]).selectExpr("doc_id", "shard AS later")
    moved = before.join(after, "doc_id").filter("shard != later")
    assert moved.filter("later != 2").isEmpty() and 0 < moved.count() < 6000


def fill(sizes, weights, total):
    """Water filling step by step."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    rest = float(total)
    while rest > 1e-9 and open_:
        level = rest / sum(weights[s] for s in open_)
        full = {s for s in open_ if target[s] + level * weights[s] >= 3 * sizes[s]}
        if not full:
            for s in open_:
                target[s] += level * weights[s]
            break
        for s in full:
            rest -= 3 * sizes[s] - target[s]
            target[s] = 3.0 * sizes[s]
        open_ -= full
    return target


def test_targets_reshare_what_is_above_the_limit(spark):
    sizes = {"a": 1000, "b": 10, "c": 5, None: 300, "z": 0}
    frame = spark.createDataFrame([(k, v, 1) for k, v in sizes.items()], "source string, source_size long, n_docs long")
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    expected = fill(sizes, weights, sum(sizes.values()))
    for r in mixing.targets(frame).collect():
        assert r.target == pytest.approx(expected[r.source])


def test_mix_comes_near_its_targets(spark, awkward):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "en", f"s{i % 4 if i % 3 else 0}", 1) for i in range(3000)]
    mixed = mixing.mix(cases.docs(spark, rows), bucket_rows=64).collect()
    assert len(mixed) == 3000
    taken, target = Counter(), {}
    for r in mixed:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
    assert all(abs(taken[s] - target[s]) <= 5 for s in target)
    again = mixing.mix(cases.docs(spark, rows).repartition(7), bucket_rows=512).collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in mixed}
    copies = {r.doc_id: r.copies for r in mixed}
    expanded = Counter(r.doc_id for r in mixing.mixed_documents(cases.docs(spark, rows)).collect())
    assert expanded == {k: v for k, v in copies.items() if v}
    found = queries.op6_mix_sources(spark, awkward).collect()
    assert len(found) == len(cases.ROWS)


def test_nothing_gives_nothing(spark, tmp_path):
    path = cases.folder(spark, tmp_path / "none", [])
    for name in ("op6_mix_sources", "op8_exact_dedup", "op10_shard_by_rendezvous"):
        assert queries.QUERIES[name](spark, path).count() == 0
    assert mixing.mixed_documents(cases.empty(spark)).columns == cases.empty(spark).columns


def test_key_buckets_hold_few_rows_at_any_weight(spark):
    """Half of a source of weight 0.1 was in the last bucket."""
    u = sharding.uniform(F.col("id"), "mix")
    for weight in (F.lit(0.1), F.lit(1.0), F.when(F.col("id") % 3 == 0, 0.1).otherwise(0.7)):
        keys = spark.range(20_000).select((F.ln(u) / -weight).alias("key"))
        rows = keys.withColumn("bucket", mixing.key_bucket(F.col("key"), F.lit(20_000 // 500))).orderBy("key").collect()
        assert max(Counter(r.bucket for r in rows).values()) <= 500
        assert all(a.bucket <= b.bucket for a, b in zip(rows, rows[1:]))
