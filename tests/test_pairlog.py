"""The append log: batches are there whole and once, whatever dies or runs twice."""

import json

import pytest

from pairloom.sources.pairlog import PairLog
from pairloom.streaming.incremental import stream_formula_pairs
from tests.test_sources import TEX, parsed

SCHEMA = "paper_id string, n long"


def rows(log):
    return sorted(tuple(r) for r in log.read().collect())


@pytest.fixture
def log(spark, tmp_path):
    return PairLog(spark, str(tmp_path / "log"), SCHEMA)


def batch(spark, k):
    return spark.createDataFrame([(f"p{k}", i) for i in range(5)], SCHEMA)


def expected(*numbers):
    return sorted((f"p{k}", i) for k in numbers for i in range(5))


def test_batches_are_added_once(spark, log):
    assert rows(log) == []
    assert log.append(batch(spark, 1), "b1") and log.append(batch(spark, 2), "b2")
    assert not log.append(batch(spark, 1), "b1")
    assert rows(log) == expected(1, 2)
    assert rows(PairLog(spark, log.path + "/", SCHEMA)) == expected(1, 2)


def test_a_writer_that_dies_before_its_manifest_leaves_nothing(spark, log, monkeypatch):
    log.append(batch(spark, 1), "b1")

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(PairLog, "_publish", die)
        log.append(batch(spark, 2), "b2")
    assert rows(log) == expected(1)
    assert log.append(batch(spark, 2), "b2") and rows(log) == expected(1, 2)


def test_of_two_writers_of_a_batch_one_wins(spark, log):
    folders = [log._write(batch(spark, 1)) for _ in range(2)]  # both have written when the first publishes
    assert [log._publish("b1", f, []) for f in folders] == [True, False]
    assert rows(log) == expected(1)
    assert log._publish("b2", log._write(batch(spark, 2)), []) and rows(log) == expected(1, 2)


def test_compaction(spark, log):
    assert not log.compact()
    for k in (1, 2, 3):
        log.append(batch(spark, k), f"b{k}")
    late = log.manifests()
    assert log.compact() and rows(log) == expected(1, 2, 3) and len(log.live()) == 1
    assert not log.append(batch(spark, 2), "b2")
    # a compaction that started from the state before has the same number, and is not published
    assert not log._publish("compaction-000000", log._write(batch(spark, 9)), [r.name for r in late])
    log.append(batch(spark, 4), "b4")
    assert log.compact() and rows(log) == expected(1, 2, 3, 4) and len(log.live()) == 1


def test_stream_into_the_log(spark, tmp_path):
    (tmp_path / "landed").mkdir()
    for n in range(3):
        paper = {**parsed(f"1.{n}"), "tex": [{"path": "m.tex", "text": TEX}]}
        (tmp_path / "landed" / f"1.{n}.json").write_text(json.dumps(paper))
    log = PairLog(spark, str(tmp_path / "out"))
    # without its own memory the stream runs its batches again, and the log takes them once
    for checkpoint in ("a", "a", "b"):
        stream = stream_formula_pairs(spark, str(tmp_path / "landed"), log, str(tmp_path / checkpoint), 2)
        assert stream.awaitTermination(120) and stream.exception() is None
    assert sorted(r.paper_id for r in log.read().collect()) == ["1.0", "1.1", "1.2"]
