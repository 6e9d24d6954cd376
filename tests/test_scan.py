"""Running values over one range exchange against a literal definition."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from pairloom.operators.scan import Running, running_values

SCHEMA = "k string, g int, at long, v long"
FOLD = {"sum": lambda a, b: a + b, "xor": lambda a, b: a ^ b, "max": max, "min": min}


@pytest.fixture(scope="module")
def values():
    """One key with most of the rows, small ones, null keys, null values."""
    rng = random.Random(5)
    rows = [("hot", 1, i, rng.choice([None, rng.randrange(-99, 99)])) for i in range(3000)]
    rows += [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), 10_000 + i, rng.randrange(-99, 99)) for i in range(400)]
    rows += [("z", 9, 1, None), ("zz", 9, 1, 5)]
    rng.shuffle(rows)
    return rows


def expected(values, how, forward, include):
    out = {}
    keyed = {}
    for row in values:
        keyed.setdefault(row[:2], []).append(row)
    for rows in keyed.values():
        rows.sort(key=lambda r: r[2], reverse=forward)
        for i, row in enumerate(rows):
            seen = [r[3] for r in rows[: i + include] if r[3] is not None]
            out[row[:3]] = reduce(FOLD[how], seen) if seen else (0 if how in ("sum", "xor") else None)
    return out


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_all_scans_at_once(spark, values, parts):
    scans = {f"{how}_{f}_{i}": Running(F.col("v"), how, f, i) for how in FOLD for f in (False, True) for i in (False, True)}
    df = spark.createDataFrame(values, SCHEMA).repartition(5)
    found = running_values(df, ["k", "g"], ["at"], parts, **scans)
    rows = found.collect()
    assert found.columns == ["k", "g", "at", "v", *scans] and len(rows) == len(values)
    for name, scan in scans.items():
        assert {(r.k, r.g, r.at): r[name] for r in rows} == expected(values, scan.how, scan.forward, scan.include_current), name


def test_one_direction_and_nothing(spark, values):
    df = spark.createDataFrame(values, SCHEMA)
    for forward in (False, True):
        rows = running_values(df, ["k", "g"], ["at"], 4, n=Running(F.lit(1), forward=forward)).collect()
        ones = [(*r[:3], 1) for r in values]
        assert {(r.k, r.g, r.at): r.n for r in rows} == expected(ones, "sum", forward, True)
        assert running_values(df.limit(0), ["k"], ["at"], n=Running(F.lit(1), forward=forward)).count() == 0


def test_small_batches(spark, values):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(values, SCHEMA)
        rows = running_values(df, ["k", "g"], ["at"], 3, a=Running(F.col("v"), "max"), b=Running(F.col("v"), "xor", True, False)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.k, r.g, r.at): r.a for r in rows} == expected(values, "max", False, True)
    assert {(r.k, r.g, r.at): r.b for r in rows} == expected(values, "xor", True, False)
