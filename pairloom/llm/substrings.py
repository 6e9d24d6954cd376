"""Substring dedup: a count-min sketch of the windows of all documents, then exact grouping of those it finds repeated.

A window is ``width`` consecutive words of one document. A word goes if a window that covers it also starts in a
document with a smaller id.

1. Every window is represented by the smallest hash of the word runs (``GRAM`` words) in it. Equal windows have equal
   representatives, so a representative stands in at least as many places as each of its windows: its count is an
   overestimate of theirs. Consecutive windows with one representative are a block, about one per 18 words.
2. Each partition makes a count-min sketch of its representatives (two rows of counters that stop at 2) and hands it
   out in slices of the hash space; sketches of one slice are merged by addition. The number of slices grows with the
   blocks, so no task holds more than ``SLICE`` counters a row, and nothing is broadcast.
3. Representatives are looked up in the merged slices, once a partition; what is estimated to stand in one place only
   is out. Collisions add to counters and never take from them, so no repeated window is lost.
4. The second pass groups exactly, by 128 bits. Blocks with equal words form a class with its smallest id: whoever is
   larger loses all windows of the block at once. That leaves the document with the smallest id of each class, and
   only where a representative has several classes, which is at the ends of passages. Their windows are hashed one by
   one, grouped, and compared with the smallest id of the window.

Copies cost a row per block before and nothing after step 4's first grouping; hot passages are aggregated before the
shuffle there. Whole texts are read three times (blocks, open windows, removal) and shuffled once, for the removal.

Defined results: a null text has no words, nothing goes from a text of fewer than ``width`` words; a null id is larger
than all others and equal to itself; rows that repeat id and text get one result each, none is smaller than the other;
no other column is looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm import common
from pairloom.llm.flat import FlatTexts

WIDTH = 50
#: Words of the runs whose smallest hash represents a window.
GRAM = 16
#: Counters of a slice in each of the sketch's two rows, at most; counters a block; windows of a block, at most.
SLICE, LOAD, LONGEST = 1 << 22, 2, 62
FILTER_BITS = 1 << 25
_BASE, _MASK = 0xD1342543DE82EF95, (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Blocks:
    """Blocks of a batch of texts: ``rep``, ``block`` (hash of the words), ``at`` (first word), ``n`` (windows)."""

    def __init__(self, texts: pa.Array, width: int):
        self.flat = flat = FlatTexts(texts)
        hashes, self.width = flat.hashes, width
        total = len(hashes)
        self._inverse = _powers(pow(_BASE, -1, 1 << 64), total + 1)
        with np.errstate(over="ignore"):
            terms = hashes * _powers(_BASE, total + 1)[:total]
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        n = max(total - width + 1, 0)
        windows = np.flatnonzero(flat.owner[:n] == flat.owner[width - 1 :][:n])
        gram = min(GRAM, width)
        grams = self.runs(np.arange(max(total - gram + 1, 0)), gram)
        rep = sliding_min(grams, width - gram + 1)[windows] if n else np.zeros(0, np.uint64)
        new = np.ones(len(windows), bool)
        new[1:] = (rep[1:] != rep[:-1]) | (windows[1:] != windows[:-1] + 1) | (flat.owner[windows[1:]] != flat.owner[windows[:-1]])
        place = np.arange(len(windows))
        new |= (place - np.maximum.accumulate(np.where(new, place, 0))) % LONGEST == 0
        starts = np.flatnonzero(new)
        self.n = np.diff(np.append(starts, len(windows)))
        self.at, self.rep = windows[starts], rep[starts]
        self.block = self.runs(self.at, self.n + (width - 1))
        self.owner = flat.owner[self.at]
        self.first = self.at - (np.cumsum(flat.words) - flat.words)[self.owner]

    def runs(self, at: np.ndarray, words) -> np.ndarray:
        """Hashes of runs of ``words`` words from ``at``."""
        with np.errstate(over="ignore"):
            raw = (self._sums[at + words] - self._sums[at]) * self._inverse[at]
            return common.mix64(raw + np.asarray(words).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.xxhash64("doc_id").alias("id_hash"), text.cast("binary").alias("text"))


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _order(no_id: str, doc_id: str) -> Column:
    return F.struct(F.col(no_id).alias("no_id"), F.col(doc_id).alias("least"))


def blocks(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, rep, block, first, n) of all blocks."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = Blocks(batch.column(3), width)
        owner = pa.array(found.owner)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(owner),
                batch.column(1).take(owner),
                pa.array(found.rep.view(np.int64)),
                pa.array(found.block.view(np.int64)),
                pa.array(found.first.astype(np.int64)),
                pa.array(found.n.astype(np.int32)),
            ],
            ["doc_id", "text_hash", "rep", "block", "first", "n"],
        )

    schema = f"doc_id {_id_type(docs)}, text_hash long, rep long, block long, first long, n int"
    return _rows(docs).mapInArrow(common.in_batches(work, rows=1024, size=2 << 20), schema)


# --- the sketch


def _salted(reps: np.ndarray, salt: int) -> np.ndarray:
    return common.mix64(reps ^ np.uint64(salt * 0xA0761D6478BD642F & _MASK))


def _by_slice(reps: np.ndarray, slices: int) -> Iterator[tuple[int, np.ndarray]]:
    where = (_salted(reps, 1) % np.uint64(slices)).astype(np.int64)
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.diff(where[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(where[part[0]]), part


def _cells(reps: np.ndarray, counters: int) -> np.ndarray:
    """(2, n) counters of representatives in the rows of their slice, the second row after the first."""
    rows = [(_salted(reps, 2 + k) % np.uint64(counters)).astype(np.int64) + k * counters for k in (0, 1)]
    return np.stack(rows)


def _whole(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(b.column(0).to_numpy() for b in batches)]).view(np.uint64)


def sketch(reps: DataFrame, slices: int, counters: int) -> DataFrame:
    """(slice, bits): merged sketches; a bit says whether its counter has reached 2."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, times = np.unique(_whole(batches), return_counts=True)
        for k, at in _by_slice(values, slices):
            cells = _cells(values[at], counters).reshape(-1)
            cells, place = np.unique(cells, return_inverse=True)
            count = np.bincount(place, np.tile(times[at], 2))
            both = [cells[count == 1].astype("<u4").tobytes(), cells[count > 1].astype("<u4").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), *(pa.array([x], pa.binary()) for x in both)], ["slice", "ones", "more"])

    def merge(table: pa.Table) -> pa.Table:
        count = np.zeros(2 * counters, np.uint8)
        for name, step in (("ones", 1), ("more", 2)):
            for value in table.column(name):
                cells = np.frombuffer(value.as_buffer(), "<u4")
                count[cells] = np.minimum(count[cells] + step, 2)
        return pa.table({"slice": table.column("slice").slice(0, 1), "bits": pa.array([np.packbits(count > 1).tobytes()], pa.binary())})

    parts = reps.mapInArrow(partial, "slice long, ones binary, more binary")
    return parts.groupBy("slice").applyInArrow(merge, "slice long, bits binary")


def repeated(reps: DataFrame, merged: DataFrame, slices: int, counters: int) -> DataFrame:
    """(rep): representatives that the sketch estimates to stand in two places or more, each once."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = np.unique(_whole(batches))
        for k, at in _by_slice(values, slices):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([values[at].tobytes()], pa.binary())], ["slice", "reps"])

    def answer(asked: pa.Table, bits: pa.Table) -> pa.Table:
        values = [np.frombuffer(x.as_buffer(), np.uint64) for x in asked.column("reps")]
        values = np.unique(np.concatenate([np.zeros(0, np.uint64), *values]))
        if bits.num_rows:
            flags = np.frombuffer(bits.column("bits")[0].as_buffer(), np.uint8)
            at = _cells(values, counters)
            values = values[((flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(0)]
        return pa.table({"rep": pa.array(values.view(np.int64))})

    asked = reps.mapInArrow(ask, "slice long, reps binary")
    return asked.groupBy("slice").cogroup(merged.groupBy("slice")).applyInArrow(answer, "rep long")


# --- exact grouping


def _filter(owners: DataFrame) -> np.ndarray:
    """A bitmap of the owners' (rep, block, id): fixed in size, so it may go to the driver and to all tasks.

    Where it is full, blocks that are not open pass too, and the join after it drops them.
    """
    place = F.pmod(F.col("rep").bitwiseXOR(F.col("block")).bitwiseXOR(F.xxhash64("least")), F.lit(FILTER_BITS))
    # value p stands in bucket (p - 1) / 32768 + 1 at bit (p - 1) % 32768
    found = (
        owners.select((place + 1).alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in found.collect():
        part = np.frombuffer(bytes(row.bits), np.uint8)
        at = (row.bucket - 1) * len(part)
        out[at : at + len(part)] = part
    return out


def _open_windows(docs: DataFrame, owners: DataFrame, width: int) -> DataFrame:
    """(rep, block, window, i, no_id, least): all windows of the blocks in ``owners`` (rep, block, no_id, least)."""
    flags = docs.sparkSession.sparkContext.broadcast(_filter(owners))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = Blocks(batch.column(3), width)
        ids = batch.column(2).to_numpy(zero_copy_only=False)[found.owner]
        place = (found.rep.view(np.int64) ^ found.block.view(np.int64) ^ ids) % FILTER_BITS
        hit = np.flatnonzero((flags.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
        n = found.n[hit]
        ends = np.cumsum(n)
        at = np.repeat(found.at[hit] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        windows = pa.ListArray.from_arrays(offsets, pa.array(found.runs(at, width).view(np.int64)))
        sides = [pa.array(x[hit].view(np.int64)) for x in (found.rep, found.block)]
        yield pa.RecordBatch.from_arrays([*sides, batch.column(0).take(pa.array(found.owner[hit])), windows], ["rep", "block", "doc_id", "windows"])

    made = _rows(docs).mapInArrow(
        common.in_batches(work, rows=1024, size=2 << 20), f"rep long, block long, doc_id {_id_type(docs)}, windows array<long>"
    )
    made = made.join(owners, ["rep", "block"]).filter(F.col("doc_id").eqNullSafe(F.col("least")))
    one = made.groupBy("rep", "block").agg(F.any_value("windows").alias("windows"), F.any_value(_order("no_id", "least")).alias("owner"))
    return one.select("rep", "block", "owner", F.posexplode("windows").alias("i", "window"))


def spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text_hash, spans) of documents that lose words: spans are (first, bits), and bit i says that the window
    from word first + i (from 0) also starts in a document with a smaller id."""
    common.prepare(docs.sparkSession)
    every = common.stage(blocks(docs, width), "blocks")
    count = every.count()
    slices = max(common.parallelism(docs.sparkSession), -(-LOAD * count // SLICE))
    counters = max(64, -(-LOAD * count // slices))
    reps = every.select("rep")
    merged = common.stage(sketch(reps, slices, counters), "sketch")
    wanted = common.stage(repeated(reps, merged, slices, counters), "repeated")
    found = every.join(wanted, "rep", "left_semi").withColumn("no_id", F.col("doc_id").isNull())
    found = common.stage(found, "candidates")

    classes = found.groupBy("rep", "block").agg(F.min(_order("no_id", "doc_id")).alias("best"))
    classes = common.stage(classes.select("rep", "block", "best.*"), "classes")
    several = classes.groupBy("rep").agg(F.count("*").alias("classes")).filter("classes > 1").drop("classes")
    owners = common.stage(classes.join(several, "rep"), "owners")
    windows = common.stage(_open_windows(docs, owners, width), "windows")
    least = windows.groupBy("rep", "window").agg(F.min("owner").alias("low"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = windows.join(least, ["rep", "window"]).filter(F.col("owner") > F.col("low"))
    masks = later.groupBy("rep", "block").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), "i")).alias("mask"))

    rows = found.join(classes.withColumnRenamed("no_id", "least_no_id"), ["rep", "block"]).join(masks, ["rep", "block"], "left")
    larger = F.struct("no_id", "doc_id") > F.struct("least_no_id", "least")
    bits = F.when(larger, F.call_function("shiftleft", F.lit(1).cast("long"), "n") - 1).otherwise(F.col("mask"))
    rows = rows.select("doc_id", "text_hash", "first", bits.alias("bits")).filter("bits IS NOT NULL")
    return rows.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "bits")).alias("spans"))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): the words that stay, joined by one space."""
    found = spans(docs, width).withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    rows = _rows(docs)
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    rows = rows.join(found, same, "left").select("doc_id", "text", "spans")

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        flat = FlatTexts(batch.column(1))
        lists = batch.column(2)
        per = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
        values = lists.flatten()
        per = np.where(lists.is_valid().to_numpy(zero_copy_only=False), per, 0)
        doc = np.repeat(np.arange(len(flat)), per)
        begin = (np.cumsum(flat.words) - flat.words)[doc] + values.field("first").to_numpy()
        set_ = (values.field("bits").to_numpy()[:, None] >> np.arange(LONGEST)) & 1
        row, i = np.nonzero(set_)
        at = begin[row] + i
        change = np.bincount(at, minlength=len(flat.starts) + 1) - np.bincount(at + width, minlength=len(flat.starts) + 1)
        gone = np.cumsum(change)[: len(flat.starts)] > 0
        kept = np.flatnonzero(~gone)
        more = np.zeros(len(kept), bool)
        more[:-1] = flat.owner[kept[1:]] == flat.owner[kept[:-1]]
        data = flat.data.copy()
        data[flat.ends[kept[more]]] = 0x20
        edge = np.zeros(len(data) + 1, np.int8)
        edge[flat.starts[kept]] += 1
        edge[flat.ends[kept] + more] -= 1
        inside = np.cumsum(edge, dtype=np.int8)[:-1].astype(bool)
        offsets = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])[flat.bounds]
        text = pa.LargeStringArray.from_buffers(len(flat), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside]))
        removed = np.bincount(flat.owner[gone], minlength=len(flat)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(flat.words), pa.array(removed), text.cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    schema = f"doc_id {_id_type(docs)}, n_words long, n_removed long, kept_text string"
    return rows.mapInArrow(common.in_batches(work, rows=1024, size=2 << 20), schema)
