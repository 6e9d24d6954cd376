"""Harmonic packing of token sequences.

A piece of length n belongs to class k = floor(capacity / n); a bin of class k takes exactly k pieces of its class,
whatever they are, so workers fill bins without asking each other. Documents may be cut, which makes classes exact: a
document is cut into full sequences, then into the powers of two in its rest, down to ``tail`` (64: with capacity 4096
at most 63 tokens of a bin of tail pieces stay empty), and what is left over is a piece of its own. Powers of two are
exact reciprocals of the capacity, and up to the square root of the capacity each class holds one length only, so
every bin but the last of each class is filled to within its piece length, and a piece's place in its bin follows from
its number alone.

Tasks number their pieces by class as they cut; how many come before a task is a sum over (task, class) counts. The
last, incomplete bins of all classes hold fewer than capacity / n pieces of each length n, about 20,000 pieces in all
for 4,096 whatever the input. They are closed together: longest first, each bin as long as the next piece fits.

Defined results: a null or empty text is the end id alone; a null doc_id stays null; rows that repeat are packed each;
an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm import common

CAPACITY = 4096


def cuts(n: int, capacity: int = CAPACITY, tail: int = 64) -> list[int]:
    """Lengths of the pieces of a document of n tokens, in order."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n > tail:
        out.append(1 << (n.bit_length() - 1))
        n -= out[-1]
    return [*out, n] if n else out


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, tail: int, id_type: str, digests: bool) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, part, rank): rank counts the task's pieces of one length.

    With ``digests`` the ids give way to their crc32 (``ids_crc32``) where they are made.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from pairloom.llm.tokenizing import encoder

        encode = encoder(tokenizer_path).encode_all
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        known: dict[int, list[int]] = {}

        def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, counts = encode(batch.column(1))
            ids, counts = np.insert(ids, np.cumsum(counts), end_id).astype("<u4"), counts + 1
            lengths, owner = [], []
            for i, n in enumerate(counts.tolist()):
                if n not in known:
                    known[n] = cuts(n, capacity, tail)
                lengths += known[n]
                owner += [i] * len(known[n])
            lengths, owner = np.array(lengths, np.int64), np.array(owner, np.int64)
            ends = np.cumsum(lengths)
            first = np.cumsum(counts) - counts
            rank = pd.Series(lengths).groupby(lengths).cumcount().to_numpy() + seen[lengths]
            seen[: capacity + 1] += np.bincount(lengths, minlength=capacity + 1)
            if digests:
                raw = memoryview(ids).cast("B")
                content = pa.array([zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())], pa.int64())
            else:
                offsets = pa.array(np.concatenate([[0], ends * 4]), pa.int64())
                buffers = [None, offsets.buffers()[1], pa.py_buffer(ids.tobytes())]
                content = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), buffers).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)),
                    pa.array(ends - lengths - first[owner]),
                    pa.array(lengths),
                    pa.array(counts[owner]),
                    content,
                    pa.array(np.full(len(lengths), part, np.int32)),
                    pa.array(rank),
                ],
                ["doc_id", "start", "length", "doc_tokens", name, "part", "rank"],
            )

        yield from common.in_batches(some, rows=16_384, size=16 << 20)(batches)

    name, kind = ("ids_crc32", "long") if digests else ("ids", "binary")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(cut, f"doc_id {id_type}, start long, length long, doc_tokens long, {name} {kind}, part int, rank long")


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, tail: int = 64, digests: bool = False
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset) of every piece; ``digests``: ids_crc32 for ids."""
    if capacity & (capacity - 1) or tail * tail > capacity:
        raise ValueError("capacity must be a power of two, and tail at most its square root")
    common.prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = common.stage(pieces(docs, tokenizer_path, end_id, capacity, tail, id_type, digests), "pieces")
    counts = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("length")
    fit = F.floor(F.lit(capacity) / F.col("length"))
    counts = counts.select(
        "part", "length", fit.alias("fit"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"), F.sum("n").over(everything).alias("all")
    )
    counts = counts.withColumn("bins", F.floor(F.col("all") / F.col("fit")))
    # one row per length: its bins come after those of shorter lengths
    classes = counts.select("length", "bins").distinct()
    shorter = F.coalesce(F.sum("bins").over(Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    classes = classes.select("length", shorter.alias("first_bin"), F.sum("bins").over(Window.partitionBy()).alias("all_bins"))
    # staged, so that its true size decides whether it is broadcast: (tasks x lengths) rows of a few numbers
    places = common.stage(counts.join(classes, "length").drop("all"), "places")
    placed = rows.join(places, ["part", "length"]).withColumn("number", F.col("before") + F.col("rank"))
    whole = F.col("number") < F.col("bins") * F.col("fit")
    out = ["doc_id", "start", "length", "doc_tokens", "ids_crc32" if digests else "ids"]
    regular = placed.filter(whole).select(
        *out,
        (F.col("first_bin") + F.floor(F.col("number") / F.col("fit"))).cast("long").alias("sequence_id"),
        ((F.col("number") % F.col("fit")) * F.col("length")).cast("long").alias("offset"),
    )

    def close(rest: pa.Table) -> pa.Table:
        rest = rest.sort_by([("length", "descending"), ("number", "ascending")])
        bins, offsets, current, used = [], [], rest["all_bins"][0].as_py(), 0
        for n in rest["length"].to_pylist():
            if used + n > capacity:
                current, used = current + 1, 0
            bins.append(current)
            offsets.append(used)
            used += n
        return rest.select(out).append_column("sequence_id", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    # fewer than capacity / n pieces of each length n: a bound that does not grow with the data
    rest = placed.filter(~whole).groupBy(F.lit("all").alias("__all")).applyInArrow(close, regular.schema)
    return regular.unionByName(rest)
