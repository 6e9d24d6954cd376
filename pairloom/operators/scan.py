"""Running values over ordered rows: one range exchange, prefixes inside partitions, one summary row per partition.

Rows are range-partitioned by keys and order, so a hot key is cut wherever its rows are many. Each partition is sorted
and streamed once per direction through numpy, batch by batch; all it remembers is the running value of the key it is
in. What it knows at its end (first and last key, running value of the last one) is one row. These rows, as many as
partitions, are combined in order and give the first key of every partition what came before it.

The rows are written and reread after the scan, since another run of a range partitioning may cut elsewhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairloom.functions.workers import ship_by_value
from pairloom.session import ensure_checkpoint_dir

_PART, _AT, _EDGE, _SINGLE = "__part", "__at", "__edge", "__single"
_NEUTRAL = {"sum": 0, "xor": 0, "max": np.iinfo(np.int64).min, "min": np.iinfo(np.int64).max}


@dataclass(frozen=True)
class Running:
    """The sum, xor, maximum or minimum of a whole-number column over the rows of a key up to this one.

    ``forward``: from this row on. Without ``include_current`` the row itself is left out. Nulls are passed over; where
    nothing has been seen, sums and xors are 0, the others null.
    """

    value: Column
    how: str = "sum"
    forward: bool = False
    include_current: bool = True


def _merged(how: str, a: int, b: int) -> int:
    if how == "sum":
        return a + b
    if how == "xor":
        return a ^ b
    return max(a, b) if how == "max" else min(a, b)


def _accumulate(how: str, values: np.ndarray, segment: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Running values that begin anew with each segment (``start``: first row of each row's segment)."""
    if how == "sum":
        return pd.Series(values).groupby(segment).cumsum().to_numpy()
    if how == "max":
        return pd.Series(values).groupby(segment).cummax().to_numpy()
    if how == "min":
        return pd.Series(values).groupby(segment).cummin().to_numpy()
    total = np.bitwise_xor.accumulate(values)
    return total ^ np.where(start > 0, total[start - 1], 0)


def _scanner(keys: Sequence[str], scans: dict[str, tuple[str, bool]], edge_column: str):
    """The work of one direction; ``scans`` name their input and output column: (how, include_current).

    ``edge_column`` says of a row whether its key is the first of the partition, and is true in the summary row.
    """

    def same_as_before(column: pa.Array) -> np.ndarray:
        a, b = column[1:], column[:-1]
        both_null = pc.and_(pc.is_null(a), pc.is_null(b))
        return pc.or_(pc.fill_null(pc.equal(a, b), False), both_null).to_numpy(zero_copy_only=False)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = schema = at = None
        single = True
        open_: dict[str, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            summary = batch.column(batch.schema.get_field_index(_PART)).is_valid()
            if pc.any(summary).as_py():  # of the pass before
                yield batch.filter(summary)
                batch = batch.filter(pc.invert(summary))
                if not batch.num_rows:
                    continue
            schema, n = pa.schema([f.with_nullable(True) for f in batch.schema]), batch.num_rows
            columns = {name: batch.column(i) for i, name in enumerate(schema.names)}
            at = columns[_AT][0].as_py()
            new = np.ones(n, bool)
            if n > 1:
                new[1:] = ~np.logical_and.reduce([same_as_before(columns[k]) for k in keys])
            head = tuple(columns[k][0].as_py() for k in keys)
            if first is None:
                first = head
            goes_on = last is not None and head == last
            single &= head == first and not new[1:].any()
            segment = np.cumsum(new) - 1
            start = np.flatnonzero(new)[segment]
            edge = (segment == 0) & (head == first)
            for name, (how, include) in scans.items():
                raw = columns[name]
                values = pc.fill_null(raw, _NEUTRAL[how]).to_numpy(zero_copy_only=False).copy()
                carry = open_[name] if goes_on else _NEUTRAL[how]
                values[0] = _merged(how, int(values[0]), carry)
                total = _accumulate(how, values, segment, start)
                open_[name] = int(total[-1])
                if not include:
                    shifted = np.where(new, _NEUTRAL[how], np.concatenate([[0], total[:-1]]))
                    shifted[0] = carry
                    total = shifted
                empty = (total == _NEUTRAL[how]) if how in ("max", "min") else None
                columns[name] = pa.array(total, pa.int64(), mask=empty)
            columns[edge_column] = pa.array(edge)
            last = tuple(columns[k][-1].as_py() for k in keys)
            yield pa.RecordBatch.from_arrays([columns[c] for c in schema.names], schema=schema)
        if first is not None:
            row = {name: None for name in schema.names}
            row |= {_PART: at, _SINGLE: single, edge_column: True, "__first": dict(zip(keys, first)), "__last": dict(zip(keys, last))}
            row |= open_
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    return work


def _carries(rows: list, scans: dict[str, str]) -> list[tuple]:
    """(partition, carried value of each scan) for partitions whose first key has begun before them."""
    out, key, total = [], None, {}
    for row in rows:
        first, last = tuple(row["__first"]), tuple(row["__last"])
        mine = {name: row[name] for name in scans}
        mine = {n: _NEUTRAL[scans[n]] if v is None else v for n, v in mine.items()}
        if key is not None and first == key:
            out.append((row[_PART], *(None if scans[n] in ("max", "min") and total[n] == _NEUTRAL[scans[n]] else total[n] for n in scans)))
            if row[_SINGLE]:
                mine = {n: _merged(scans[n], total[n], v) for n, v in mine.items()}
        key, total = last, mine
    return out


def running_values(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None, **scans: Running
) -> DataFrame:
    """``df`` with one more column for each of ``scans``.

    The order must tell all rows of a key apart, or what stands at equal places comes in any order. Keys may be null.
    An empty table stays empty. Partitions are as many as shuffle partitions unless ``parts`` says otherwise.
    """
    spark = df.sparkSession
    ship_by_value(__name__)
    folder = f"{ensure_checkpoint_dir(spark)}/scan-{uuid.uuid4().hex}"
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = df.columns
    key_type = df.select(*keys).schema.simpleString()
    empty = {
        _PART: "int", _SINGLE: "boolean", f"{_EDGE}0": "boolean", f"{_EDGE}1": "boolean",
        "__first": key_type, "__last": key_type,
    }
    rows = df.withColumns({out: s.value.cast("long") for out, s in scans.items()})
    rows = rows.repartitionByRange(parts, *keys, *order).withColumn(_AT, F.spark_partition_id())
    rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in empty.items()})
    passes = [(i, {o: s for o, s in scans.items() if s.forward == bool(i)}) for i in (0, 1)]
    for i, mine in passes:
        if mine:
            ordered = [F.desc(c) if i else F.asc(c) for c in (*keys, *order)]
            work = _scanner(keys, {o: (s.how, s.include_current) for o, s in mine.items()}, f"{_EDGE}{i}")
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
            rows = rows.sortWithinPartitions(*ordered).mapInArrow(work, schema)
    rows.withColumn("__kind", F.col(_PART).isNotNull()).write.partitionBy("__kind").parquet(folder)
    kind = spark.read.schema(T.StructType([*schema, T.StructField("__kind", T.BooleanType())])).parquet(folder)
    # one row per partition and direction
    found = kind.where("__kind").select(_PART, _SINGLE, f"{_EDGE}0", f"{_EDGE}1", "__first", "__last", *scans).collect()
    rows = kind.where("NOT __kind")
    for i, mine in passes:
        hows = {o: s.how for o, s in mine.items()}
        summaries = sorted((r for r in found if r[f"{_EDGE}{i}"]), key=lambda r: r[_PART], reverse=bool(i))
        carries = _carries(summaries, hows)
        if not carries:
            continue
        carried = spark.createDataFrame(carries, f"{_AT} int, " + ", ".join(f"`__c_{o}` long" for o in hows))
        rows = rows.join(F.broadcast(carried), _AT, "left")
        for o, how in hows.items():
            carry = F.when(F.col(f"{_EDGE}{i}"), F.col(f"__c_{o}"))
            if how in ("max", "min"):
                both = (F.greatest if how == "max" else F.least)(F.col(o), carry)
            elif how == "sum":
                both = F.col(o) + F.coalesce(carry, F.lit(0))
            else:
                both = F.col(o).bitwiseXOR(F.coalesce(carry, F.lit(0)))
            rows = rows.withColumn(o, both)
    return rows.select(*names, *scans)

